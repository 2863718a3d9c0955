"""Operators for building training data: each module holds one of them, `queries` applies them to the tables."""
