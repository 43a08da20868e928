"""File-source streaming extension."""
