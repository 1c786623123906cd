"""Clickstream and ad-click analytics as plain PySpark DataFrame transformations."""
