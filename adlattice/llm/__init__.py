"""Operators that prepare documents for training a language model. Nothing else in the library imports them."""
