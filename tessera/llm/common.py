"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.shipping import ensure_importable


def required(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` cut down to the named columns, cast to the given types.

    Extra columns never travel further, so their names cannot clash with the
    columns an operator derives.
    """
    ensure_importable(df.sparkSession)
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()])


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it until none of the frames has it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[int, list]]:
    """(first row, texts) runs of a batch with about ``max_bytes`` bytes of
    text each; nulls stay ``None``. A longer text forms a run of its own. Only
    the texts of one run are held at a time."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > first and size + n > max_bytes:
            yield first, texts.slice(first, i - first).to_pylist()
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, texts.slice(first).to_pylist()


def gather(flat: np.ndarray, offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenation of the slices ``flat[offset[i] : offset[i] + length[i]]``."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    index = np.arange(total, dtype=np.int64) + np.repeat(offset - (ends - length), length)
    return flat[index]


_TYPES = {"long": T.LongType, "int": T.IntegerType, "string": T.StringType, "double": T.DoubleType,
          "boolean": T.BooleanType, "binary": T.BinaryType}


def struct(**fields: str) -> T.StructType:
    """Schema from ``name="type"`` pairs; ``[type]`` is an array of it."""
    def kind(name: str) -> T.DataType:
        return T.ArrayType(kind(name[1:-1])) if name[0] == "[" else _TYPES[name]()
    return T.StructType([T.StructField(k, kind(v)) for k, v in fields.items()])
