"""Masking of unbounded sources."""
