"""Readers, listings and sinks."""
