"""Readers, integrity checks and sinks."""
