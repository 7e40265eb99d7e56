"""Derived inputs and the registered queries with their SQL checks."""
