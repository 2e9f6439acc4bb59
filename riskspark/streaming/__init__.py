"""Structured Streaming versions of admission, scoring, monitoring, labels and drift."""
