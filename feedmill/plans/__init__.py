"""Whole feeds put together from the operators."""
