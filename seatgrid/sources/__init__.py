"""Readers, writers and the adapters from relational tables to the input collections."""
