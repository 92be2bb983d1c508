"""Readers, catalogs and sinks."""
