"""Readers and writers of the catalogue's files and tables."""
