"""Readers and writers: JSON lines, tab-separated token files, reports."""
