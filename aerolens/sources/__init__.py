"""Readers and replay-safe writers."""
