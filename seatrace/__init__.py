"""Vessel-position analytics expressed as Spark DataFrame transformations."""
