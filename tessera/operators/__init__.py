"""Relational operators: projection, validation, joins, aggregation,
statistics, ordering and windows. Each is ``fn(df, ...) -> DataFrame``."""
