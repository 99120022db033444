"""Partitioned layouts, external tables, inserts and text files."""
