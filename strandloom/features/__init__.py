"""Hashed feature vectors of nodes and edges; sparse entries and dense arrays both stay distributed."""
