"""Spark jobs over regulatory financial disclosures."""
