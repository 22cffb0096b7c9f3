"""Composed plans over several operators."""
