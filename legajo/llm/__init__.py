"""Operators for training data made from the documents; nothing else in the library imports this package."""
