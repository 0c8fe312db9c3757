"""Structured Streaming scoring of JSON records."""
