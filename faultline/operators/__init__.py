"""Relational operators over sensor readings, feature tables and scores."""
