"""Structured Streaming forms of the batch operators; each gives its batch twin's result."""
