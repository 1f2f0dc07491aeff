"""Readers, writers and the mapping of the given tables to the domain rows."""
