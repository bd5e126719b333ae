"""Playtide: media-engagement analytics as plain PySpark DataFrame jobs."""
