"""Structured Streaming jobs with the batch operators' semantics."""
