"""Readers, writers and the synthetic generator."""
