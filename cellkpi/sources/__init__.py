"""Readers, schema registry, store and sinks."""
