"""Registry of the queries that bind operators to the test tables.

Each entry is a callable ``(spark, sf_dir) -> DataFrame`` plus, where the
operator is expressible in SQL, an independent DuckDB SQL twin used as the
correctness oracle. Column names and types are aligned on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from tessera.shipping import ensure_importable
            ensure_importable(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every bindings module so that its queries register."""
    import importlib
    import pkgutil

    from tessera.plans import bindings

    for m in pkgutil.iter_modules(bindings.__path__):
        importlib.import_module(f"tessera.plans.bindings.{m.name}")


def sround(expr: str, digits: int) -> str:
    """DuckDB expression rounding a DOUBLE the way Spark's ``round`` does
    (HALF_UP on the shortest decimal text of the double)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE)"
