"""Operators that prepare large training corpora."""
