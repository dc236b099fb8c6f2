"""Composed plans: warehouse models, serving queries, registered queries."""
