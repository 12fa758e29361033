"""Readers, writers and decoders."""
