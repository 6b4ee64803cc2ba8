"""Operators for the preparation of training text, each on whole tables. Nothing else in the library imports this."""
