"""Derived fixture tables and the registry of named queries."""
