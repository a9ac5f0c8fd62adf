"""Bindings of operators to the test tables (one module per build step)."""
