"""Operators that prepare large text corpora for model training."""
