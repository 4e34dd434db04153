"""Operators for preparing language-model training data (an optional part of the library)."""
