"""Structured Streaming forms of file tracking, incremental copy and event folds."""
