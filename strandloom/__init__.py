"""Strandloom: facts as triples, enrichment rules, graphs, features and lookup tables on Spark."""
