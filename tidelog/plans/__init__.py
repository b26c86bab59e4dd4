"""Fixture logs from the driver tables, the named queries and their SQL oracle."""
