"""Composed queries: each named operator on the adapters, with its SQL."""
