"""Whole jobs, from arrived files to a written layout or report."""
