"""Operators that prepare text and vectors for training language models. Nothing outside this folder needs it."""
