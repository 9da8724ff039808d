"""Functions."""
