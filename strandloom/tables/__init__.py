"""Lookup tables by day, and the questions they answer."""
