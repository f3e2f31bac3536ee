"""Readers, derived inputs, feed parsing and writers."""
