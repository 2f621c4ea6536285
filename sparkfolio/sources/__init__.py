"""Readers, writers and landing-zone operators."""
