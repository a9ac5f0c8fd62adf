"""Composite jobs built from the operators (one module per reference job)."""
