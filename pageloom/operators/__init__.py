"""Operators of the page-annotation engine."""
