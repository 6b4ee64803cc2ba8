"""Readers and writers: lines, delimited text, CSV, result formats, tables."""
