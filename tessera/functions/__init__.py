"""Column functions (scalar text, HTML, JSON and nested-field work).

They return Columns built from built-in Spark expressions, so they stay
inside whole-stage codegen; only HTML extraction runs Python (Arrow batches).
"""
