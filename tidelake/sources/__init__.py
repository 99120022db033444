"""Readers for files, catalog tables and literal rows."""
