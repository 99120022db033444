"""Arrived files as streams that run until nothing is left, then stop."""
