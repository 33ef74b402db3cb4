"""Readers and writers: annotation documents, vector packages, rasters, tables, folders."""
