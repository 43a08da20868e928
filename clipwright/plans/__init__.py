"""Registered queries over the project's tables, and their SQL twins."""
