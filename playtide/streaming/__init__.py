"""Structured Streaming jobs; their row logic also runs on batch frames."""
