"""Readers: N-Triples, Turtle in Parquet, several sources at once, and direct feeds."""
