"""Operators for preparing training text at scale; see the README's table."""
