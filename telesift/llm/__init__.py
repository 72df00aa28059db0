"""Operators that prepare a corpus for language-model training. Nothing else in the library imports this package."""
