"""Reusable DataFrame transformations."""
