"""Readers of landed API exports, and table writers."""
