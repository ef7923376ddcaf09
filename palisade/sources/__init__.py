"""Readers and writers: connection tables, fitted artifacts, run summaries."""
