"""Structured Streaming over daily drops."""
