"""Readers and writers (inventory S1-S17): explicit schemas, safe parsing,
per-file verdicts computed as DataFrames."""
