"""Operators for preparing training text and vectors.

Nothing outside this subpackage imports it.  ``queries`` maps query names to callables,
``corpus_pipeline`` at the repository top chains five of the operators.
"""
