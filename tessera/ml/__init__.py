"""Feature preparation and models as Spark ML stages (inventory M1-M36, U1-U3).

Fitting reads bounded statistics (a few numbers per column) in a fixed
number of aggregation passes; transforming is a projection of built-in
expressions, so a fitted stage adds no shuffle and stays in codegen.
"""
