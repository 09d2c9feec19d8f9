"""Operators for training data: ten building blocks and their queries."""
