"""Readers, writers and the mapping of the driver tables onto event shapes."""
