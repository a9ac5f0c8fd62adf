"""Packing of documents into fixed-length sequences by sum of squares.

``pack_documents`` turns documents into token pieces and places the pieces
into sequences of at most ``capacity`` tokens. The placement is the
sum-of-squares rule: with N(g) open sequences of residual gap g, a piece goes
where the sum of N(g)^2 over all gaps becomes smallest (a new sequence counts
as one more place to go). Pieces are taken longest first, so what the rule
leaves open is filled by the short ones.

Pieces are placed in groups of at most about ``group_pieces`` pieces. A group
is one task whose state is one counter and one stack per gap. Groups are
dealt out by a hash, so no source or size is concentrated, and one group
wastes at most a few sequences however many groups there are.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import required, struct, text_slices
from tessera.llm.pretoken import PieceEncoder
from tessera.session import write_table

_ENCODERS: dict[str, PieceEncoder] = {}


def byte_characters() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves,
    the others for the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def tokenizer_encoder(definition: str) -> PieceEncoder:
    """Encoder over a ``tokenizers`` definition (the text of its file), kept
    per Python worker. Strings of special tokens are ordinary text. Pieces go
    straight to the tokenizer's merge model."""
    name = hashlib.sha1(definition.encode()).hexdigest()
    if name not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_str(definition)
        tok.encode_special_tokens = True
        model, alphabet = tok.model, byte_characters()

        def pieces(words: list[str]) -> list:
            return [[t.id for t in model.tokenize(w.encode().decode("latin-1").translate(alphabet))] if w else []
                    for w in words]

        _ENCODERS[name] = PieceEncoder(pieces, lambda t: tok.encode(t, add_special_tokens=False).ids)
    return _ENCODERS[name]


PIECES = struct(doc_id="long", piece="int", start="long", length="long", ids_crc32="long")
PLACES = struct(doc_id="long", piece="int", start="long", length="long", ids_crc32="long",
                sequence_id="long", offset="long")


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of each document's ids (its tokens, then ``end_id``).

    Documents of more than ``capacity`` ids are cut into full pieces; only the
    first piece may be shorter. A null or empty text is the single ``end_id``.
    Columns: doc_id, piece, start, length, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers). One row per document row, repeated
    rows included.
    """
    docs = required(docs, {"doc_id": "long", "text": "string"})
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_encoder(definition.value)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, texts in text_slices(batch, "text"):
                rows = []
                for k, ids in enumerate(encoder.encode([t or "" for t in texts])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    begin, n, piece = 0, len(ids), 0
                    while begin < n:
                        size = (n - 1) % capacity + 1 if begin == 0 else capacity
                        rows.append((names[first + k], piece, begin, size, zlib.crc32(ids[begin:begin + size])))
                        begin, piece = begin + size, piece + 1
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=PIECES.names)

    return docs.mapInArrow(cut, PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each length, in the given order.

    A piece goes into the open sequence for which the sum over all gaps of the
    squared number of open sequences becomes smallest, ties into the smallest
    gap; a new sequence is opened when no open one has room. A full sequence
    is closed and counts no more.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bin_of, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    for k, size in enumerate(lengths.tolist()):
        gaps = size + np.flatnonzero(count[size:])
        if len(gaps):
            change = 2 - 2 * count[gaps] + 2 * count[gaps - size]
            if gaps[0] == size:
                change[0] = 1 - 2 * count[size]
            gap = int(gaps[change.argmin()])
            here = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, here = capacity, opened
            opened += 1
        bin_of[k], offset[k] = here, capacity - gap
        if gap > size:
            stacks[gap - size].append(here)
            count[gap - size] += 1
    return bin_of, offset


def pack_pieces(pieces: DataFrame, capacity: int = 2048, group_pieces: int = 200_000) -> DataFrame:
    """Places the rows of a written table of pieces (``length`` of 1 to
    ``capacity``) into sequences; adds ``sequence_id`` and ``offset``.

    Groups have ``group_pieces`` rows on average. The group of a row follows
    from its place in the table, so equal rows spread over all groups and a
    lost task gives the same placement again.
    """
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32", "start"],
                                ascending=[False, True, True, True, True], kind="stable")
        bin_of, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=(int(key[0]) << 40) + bin_of, offset=offset)[PLACES.names]

    return dealt.groupBy("group").applyInPandas(place, PLACES)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                   group_pieces: int = 200_000) -> DataFrame:
    """Token pieces of all documents, placed into sequences.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Pieces of a sequence follow each other without gaps from offset 0. Null
    and empty texts give one piece holding ``end_id``; repeated rows and rows
    without an id are packed like any other; an empty table gives no rows.
    """
    pieces = write_table(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    return pack_pieces(pieces, capacity, group_pieces)
