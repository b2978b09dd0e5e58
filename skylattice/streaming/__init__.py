"""Micro-batch pipeline."""
