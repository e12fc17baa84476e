"""Operators for training-data corpora; ``queries`` registers them."""
