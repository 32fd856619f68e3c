"""Relational operators over event tables, each DataFrame -> DataFrame."""
