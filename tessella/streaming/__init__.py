"""Structured Streaming wrappers over arriving sample files."""
