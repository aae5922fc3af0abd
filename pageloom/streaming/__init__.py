"""Streaming of the page-annotation engine."""
