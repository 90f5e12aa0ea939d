"""Structured Streaming: what can be kept up to date as sequences arrive."""
