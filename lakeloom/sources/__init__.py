"""Readers, writers and table helpers."""
