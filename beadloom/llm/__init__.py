"""Operators for building training data from document tables; nothing else in the library imports them."""
