"""Composed plans: the registered queries and the end-to-end pipeline."""
