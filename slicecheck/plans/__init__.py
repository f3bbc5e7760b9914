"""Whole checks put together from the operators."""
