"""The operators, by subject."""
