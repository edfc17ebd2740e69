"""Readers, writers and the adapters from the shared star-schema tables."""
