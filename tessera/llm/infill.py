"""Fill-in-middle transformation of whole texts by SWAR words.

A text is cut at two token ends into prefix, middle and suffix, which are put
in another order behind marker strings. Texts stay UTF-8 bytes: a batch of
texts is viewed as uint64 words of eight bytes. Arithmetic on whole words marks
the bytes that end a token and those that begin a code point, a bit count per
word and its cumulative sum find the word that holds the wanted token end, and
a select inside that word finds the byte. No text is ever a list of tokens.

A token is white space (bytes 9 to 13 and 32) and the other characters that
follow it; white space at the end of a text is a token of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import gather, required, struct

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_BYTE = 0x0101010101010101
HIGH, LOW = np.uint64(0x80 * _BYTE), np.uint64(0x7F * _BYTE)
_ONE, _SEVEN, _EIGHT, _LAST = np.uint64(1), np.uint64(7), np.uint64(8), np.uint64(56)
_TEXT_BYTES = 1 << 22


def each(byte: int) -> np.uint64:
    """A word with ``byte`` in all its eight places."""
    return np.uint64(byte * _BYTE)


def white(x: np.ndarray) -> np.ndarray:
    """Words with the high bit of each byte that is white space."""
    low, y = x & LOW, x ^ each(0x20)
    blank = ~((y & LOW) + LOW | y)  # high bit where y is 0
    control = low + each(0x80 - 0x09) & ~(low + each(0x80 - 0x0E)) & ~x  # 9 to 13
    return (blank | control) & HIGH


class Words:
    """Texts as words: text i has the words ``first[i]`` up to ``first[i + 1]``,
    filled up with at least one blank. ``ends`` marks the last byte of each
    token, ``starts`` the first byte of each code point."""

    def __init__(self, data: np.ndarray, offset: np.ndarray, size: np.ndarray):
        words = size // 8 + 1
        self.size, self.first = size, np.append(0, np.cumsum(words))
        held = np.full(int(self.first[-1]) * 8, 0x20, np.uint8)
        place = np.arange(int(size.sum())) + np.repeat(self.first[:-1] * 8 - (np.cumsum(size) - size), size)
        held[place] = gather(data, offset, size)
        x = held.view("<u8")
        blank = white(x)
        after = (blank >> _EIGHT) | (np.append(blank[1:], np.uint64(0)) << _LAST)
        self.ends = ~blank & HIGH & after
        last = self.first[:-1] * 8 + size - 1
        tail = np.flatnonzero(size > 0)
        tail = tail[np.isin(held[last[tail]], [9, 10, 11, 12, 13, 32])]
        self.ends[last[tail] // 8] |= np.uint64(0x80) << (_EIGHT * (last[tail] % 8).astype(np.uint64))
        self.starts = ~(x & ~(x << _ONE)) & HIGH
        self.ends_before = np.append(0, np.cumsum(np.bitwise_count(self.ends), dtype=np.int64))
        self.starts_before = np.append(0, np.cumsum(np.bitwise_count(self.starts), dtype=np.int64))

    def counts(self) -> np.ndarray:
        """Number of tokens of each text."""
        return self.ends_before[self.first[1:]] - self.ends_before[self.first[:-1]]

    def select(self, text: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Bytes of each of ``text`` up to the end of its ``token``-th token (0: none)."""
        wanted = self.ends_before[self.first[text]] + token
        word = np.maximum(np.searchsorted(self.ends_before, wanted) - 1, 0)
        rank, marks = wanted - self.ends_before[word], self.ends[word]
        for _ in range(7):  # drop the lowest mark until the wanted one is the lowest
            more = rank > 1
            marks = np.where(more, marks & (marks - _ONE), marks)
            rank = rank - more
        lowest = np.bitwise_count((marks & (~marks + _ONE)) - _ONE).astype(np.int64) // 8
        return np.where(token > 0, word * 8 + lowest + 1 - self.first[text] * 8, 0)

    def characters(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Code points in the first ``at`` bytes of each of ``text``."""
        begin = self.first[text]
        word, rest = begin + at // 8, (at % 8).astype(np.uint64)
        part = self.starts[word] & ((_ONE << (rest * _EIGHT)) - _ONE)
        return self.starts_before[word] - self.starts_before[begin] + np.bitwise_count(part)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offset, size) of a binary column; nulls have size 0."""
    if pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.binary()), np.int32
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    size = np.diff(ends)
    if column.null_count:
        size[column.is_null().to_numpy(zero_copy_only=False)] = 0
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends[:-1], size


def draws(ids: list, seed: int) -> np.ndarray:
    """Four draws per id: the first 8-digit groups of the hex SHA-256 of
    ``seed:id`` (nothing for a null id), as unsigned integers."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def fill_in_middle(docs: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) per document row.

    ``rate`` percent of the texts are transformed, ``spm`` percent of these
    suffix first (form spm, else psm); the others, empty texts and texts that
    hold a marker are plain and stay as they are, with null lengths. ``n`` is
    the number of tokens; the cuts are equally likely after any number of them.
    All draws come from the id, so equal ids are cut alike; rows without an id
    share the draws of an empty id. Null texts are empty. Repeated rows stay;
    an empty table gives none. Very long texts are one run of words each.
    """
    docs = required(docs, {"doc_id": "long", "text": "binary"})
    schema = struct(doc_id="long", n="long", form="string", prefix_chars="long", middle_chars="long", output="binary")
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def transform(ids: list, column: pa.Array) -> pa.RecordBatch:
        h = draws(ids, seed)
        words = Words(*buffers(column))
        n = words.counts()
        texts = [t or b"" for t in column.to_pylist()]
        plain = (words.size == 0) | (h[:, 2] % 100 >= rate) | np.array([any(m in t for m in marks) for t in texts], bool)
        cut = np.flatnonzero(~plain)
        one, two = h[cut, 0] % (n[cut] + 1), h[cut, 1] % (n[cut] + 1)
        a, b = words.select(cut, np.minimum(one, two)), words.select(cut, np.maximum(one, two))
        lengths = np.zeros((2, len(texts)), np.int64)
        lengths[0, cut] = words.characters(cut, a)
        lengths[1, cut] = words.characters(cut, b) - lengths[0, cut]
        first = h[cut, 3] % 100 < spm
        form, out = ["plain"] * len(texts), texts
        p, s, m = marks
        for k, x, y, suffix_first in zip(cut.tolist(), a.tolist(), b.tolist(), first.tolist()):
            t = texts[k]
            form[k] = "spm" if suffix_first else "psm"
            out[k] = b"".join((s, t[y:], p, t[:x], m, t[x:y]) if suffix_first else (p, t[:x], s, t[y:], m, t[x:y]))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n), pa.array(form, pa.string()), *(pa.array(c, pa.int64(), mask=plain) for c in lengths),
             pa.array(out, pa.binary())], names=schema.names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            total = np.cumsum(buffers(batch.column(1))[2])
            begin = 0
            while begin < len(ids):  # runs of about _TEXT_BYTES bytes; a longer text is a run of its own
                before = total[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(total, before + _TEXT_BYTES, side="right")))
                yield transform(ids[begin:end], batch.column(1).slice(begin, end - begin))
                begin = end

    return docs.mapInArrow(scan, schema).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, by its form."""
    def between(start: str, end: str) -> Column:
        return F.substring_index(F.substring_index(output, start, -1), end, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))).otherwise(output))
