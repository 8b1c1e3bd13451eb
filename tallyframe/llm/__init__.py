"""Operators for training data: each module holds one operator, its registered query and its SQL."""
