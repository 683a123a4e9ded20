"""Streaming queries around the operators."""
