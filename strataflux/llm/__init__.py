"""Operators that prepare text corpora and large numeric collections for model training."""
