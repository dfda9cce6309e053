"""Nodes with dense ids, typed edges, paths."""
