"""Operators for preparing training text: one module each, their queries and SQL beside them."""
