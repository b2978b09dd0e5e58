"""Decoding, readers, writers and the result tables."""
