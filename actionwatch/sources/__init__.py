"""Readers, normalisers, sinks and adapters."""
