"""Readers, and the table store the pipelines read from and append to."""
