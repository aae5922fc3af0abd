"""Operators that prepare large text corpora for training language models. Nothing outside this folder imports it."""
