"""Relational building blocks the reports are composed of."""
