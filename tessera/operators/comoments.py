"""Mergeable moment matrices of many columns in one pass.

A task turns its rows into small matrices with one matrix product per Arrow
batch; matrices of tasks are merged in two steps, so no number of columns makes
a plan of as many expressions, and no reducer meets all tasks at once. Sums are
kept around a shift near the data, so large values lose no digits.

* :class:`Moments` - count, mean and centred co-moments of complete rows;
* :class:`PairMoments` - the same for every pair of columns over the rows in
  which both have a value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.shipping import ensure_importable

#: Matrices of this many shares of the tasks are merged before the last step.
PARTS = 64
_SCHEMA = "cell int, part int, held binary"


@dataclass
class Moments:
    """``n`` rows with ``mean`` and centred co-moments ``c`` (sums of products)."""

    n: float
    mean: np.ndarray
    c: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        x = x[~np.isnan(x).any(axis=1)]
        mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        return cls(float(len(x)), mean, (x - mean).T @ (x - mean))

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        d = other.mean - self.mean
        return Moments(n, self.mean + d * (other.n / n), self.c + other.c + np.outer(d, d) * (self.n * other.n / n))

    def at(self, index: Sequence[int]) -> Moments:
        """Moments of some of the columns."""
        return Moments(self.n, self.mean[index], self.c[np.ix_(index, index)])

    def mapped(self, matrix: np.ndarray, constant: np.ndarray) -> Moments:
        """Moments of the columns ``matrix @ x + constant``."""
        return Moments(self.n, matrix @ self.mean + constant, matrix @ self.c @ matrix.T)

    def dump(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.c.ravel()]).tobytes()

    @classmethod
    def load(cls, held: bytes, d: int) -> Moments:
        x = np.frombuffer(held)
        return cls(float(x[0]), x[1:d + 1], x[d + 1:].reshape(d, d))


@dataclass
class PairMoments:
    """For columns i, j over the rows in which both have a value: their number
    ``n``, the sums ``s`` of i, ``ss`` of its square and ``sp`` of the product,
    all of values less ``shift``."""

    shift: np.ndarray
    n: np.ndarray
    s: np.ndarray
    ss: np.ndarray
    sp: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> PairMoments:
        has = ~np.isnan(x)
        p = has.astype(float)
        filled = np.where(has, x, 0.0)
        shift = filled.sum(axis=0) / np.maximum(p.sum(axis=0), 1)
        y = np.where(has, x - shift, 0.0)
        return cls(shift, p.T @ p, y.T @ p, (y * y).T @ p, y.T @ y)

    def merged(self, other: PairMoments) -> PairMoments:
        # a column without a value on one side takes the other side's shift
        own, shift = np.diag(self.n) > 0, np.where(np.diag(self.n) > 0, self.shift, other.shift)
        d = np.where(own, other.shift - self.shift, 0.0)[:, None]
        s = other.s + d * other.n
        ss = other.ss + 2 * d * other.s + d * d * other.n
        sp = other.sp + d * other.s.T + other.s * d.T + d * d.T * other.n
        return PairMoments(shift, self.n + other.n, self.s + s, self.ss + ss, self.sp + sp)

    def correlation(self) -> np.ndarray:
        """Pearson's r of each pair; NaN with fewer than two common rows or
        where one column does not vary in them."""
        with np.errstate(divide="ignore", invalid="ignore"):
            square = self.ss - self.s ** 2 / self.n
            both = square * square.T
            r = (self.sp - self.s * self.s.T / self.n) / np.sqrt(both)
            # what is left of equal values is rounding
            flat = square <= 1e-14 * (self.ss + self.n * self.shift[:, None] ** 2 * 1e-2)
        r[(self.n < 2) | flat | flat.T] = np.nan
        return np.clip(r, -1, 1)

    def dump(self) -> bytes:
        return np.concatenate([self.shift, *(m.ravel() for m in (self.n, self.s, self.ss, self.sp))]).tobytes()

    @classmethod
    def load(cls, held: bytes, d: int) -> PairMoments:
        x = np.frombuffer(held)
        return cls(x[:d], *x[d:].reshape(4, d, d))


def moments_table(df: DataFrame, columns: Sequence[str], kind: type, cell: str | None = None,
                  expand: Callable[[np.ndarray], np.ndarray] | None = None, width: int | None = None) -> DataFrame:
    """(cell, part, held): one merged ``kind`` per value of the integer column
    ``cell`` (0 without one), of ``columns`` or of the ``width`` columns that
    ``expand`` makes of them. NULL counts as NaN, a missing value."""
    width = width or len(columns)
    key = F.col(f"`{cell}`").cast("int") if cell else F.lit(0)
    rows = df.select(key.alias("cell"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def cells_of(batch: pa.RecordBatch) -> Iterator[tuple[int, object]]:
        cells = batch.column(0).to_numpy(zero_copy_only=False)
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]).astype(float)
        x = expand(x) if expand else x
        for c in np.unique(cells):
            yield int(c), kind.of(x[cells == c])

    return _merged_table(rows, cells_of, kind, width)


def _merged_table(rows: DataFrame, cells_of: Callable[[pa.RecordBatch], Iterator], kind: type, width: int) -> DataFrame:
    """(cell, part, held): the (cell, ``kind``) of all batches of ``rows``, merged per cell."""
    ensure_importable(rows.sparkSession)

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for (c, part), m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([part], pa.int32()), pa.array([m.dump()], pa.binary())],
                                             names=["cell", "part", "held"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        part = TaskContext.get().partitionId() % PARTS
        for batch in batches:
            for c, m in cells_of(batch):
                key = c, part
                held[key] = held[key].merged(m) if key in held else m
        yield from emit(held)

    def merge(last: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}
            for batch in batches:
                for c, part, raw in zip(*(x.to_pylist() for x in batch.columns)):
                    m, key = kind.load(raw, width), (c, 0 if last else part)
                    held[key] = held[key].merged(m) if key in held else m
            yield from emit(held)
        return run

    some = rows.mapInArrow(scan, _SCHEMA).repartition("cell", "part").mapInArrow(merge(False), _SCHEMA)
    return some.repartition("cell").mapInArrow(merge(True), _SCHEMA)


def moments_by_column(df: DataFrame, expand: dict[int, Callable[[np.ndarray], np.ndarray]], width: int) -> dict[int, Moments]:
    """One :class:`Moments` per column place in ``expand``, of the ``width``
    columns that it makes of the present values of that column of doubles. What
    it makes beyond the range of doubles leaves moments that are no numbers."""
    def cells_of(batch: pa.RecordBatch) -> Iterator[tuple[int, Moments]]:
        for k, (i, make) in enumerate(expand.items()):
            x = batch.column(k).to_numpy(zero_copy_only=False).astype(float)
            x = x[~np.isnan(x)]
            with np.errstate(all="ignore"):
                made = make(x)
                if len(x):
                    yield i, Moments.of(np.where(np.isnan(made), np.inf, made))

    rows = df.select(*[F.col(f"`{df.columns[i]}`") for i in expand])
    return {r["cell"]: Moments.load(bytes(r["held"]), width) for r in _merged_table(rows, cells_of, Moments, width).collect()}


def moments_by_cell(df: DataFrame, columns: Sequence[str], cell: str | None = None, expand: Callable | None = None,
                    width: int | None = None) -> dict[int, Moments]:
    """One :class:`Moments` per cell: a matrix of columns x columns each, read
    to the driver."""
    width = width or len(columns)
    table = moments_table(df, columns, Moments, cell, expand, width)
    return {r["cell"]: Moments.load(bytes(r["held"]), width) for r in table.collect()}


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(col_a, col_b, r)`` for every ordered pair of columns over the rows in
    which both have a value, from one pass; NULL where r is undefined, 1 for a
    column with itself."""
    names, width = list(columns), len(columns)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(2).to_pylist():
                r = PairMoments.load(raw, width).correlation()
                np.fill_diagonal(r, 1.0)
                flat = r.ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, width)), pa.array(np.tile(names, width)),
                                                  pa.array(flat, pa.float64(), mask=np.isnan(flat))], names=["col_a", "col_b", "r"])

    table = moments_table(df, names, PairMoments)
    return table.mapInArrow(pairs, "col_a string, col_b string, r double")
