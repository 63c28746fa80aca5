"""Composed jobs and the registry of named queries."""
