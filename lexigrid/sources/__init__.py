"""Readers and writers: documents, the stored index, result CSV files."""
