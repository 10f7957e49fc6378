"""Operators for preparing language-model training data, and their queries.

Self-contained: nothing else in the library imports this subpackage.
"""
