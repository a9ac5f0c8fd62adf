"""Byte-level BPE: ranked merges over the byte pieces of distinct words.

``fold_words`` is the method in Spark's higher-order functions: a word is an
array of byte pieces, ``aggregate`` folds the merges over it (each step joins
the neighbours whose joined bytes have the lowest rank), and ranks come from a
literal map. It encodes the dictionary of frequent words. The words beyond the
dictionary are folded with the same rule in lock step on arrays, where they
occur: joining every occurrence with a table of all distinct words would
shuffle several times the corpus. Decoding concatenates the pieces' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import gather, required, struct, text_slices
from tessera.llm.pretoken import PieceEncoder
from tessera.llm.syncmers import let

SLOTS = 1 << 15


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 piece and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of small maps, in which a piece stands
    at its CRC-32 (a single map would be searched from end to end). Bytes are
    written as the characters of the same numbers."""
    slots: list[dict[str, int]] = [{} for _ in range(SLOTS)]
    for piece, rank in ranks.items():
        text = piece.decode("latin-1")
        slots[zlib.crc32(text.encode()) % SLOTS][text] = rank
    return F.from_json(F.lit(json.dumps(slots)), T.ArrayType(T.MapType(T.StringType(), T.IntegerType())))


def fold_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``words`` (column ``word``) with ``ids``, by a fold of ranked merges."""
    table = rank_map(ranks)

    def rank(piece: Column) -> Column:
        slot = F.pmod(F.crc32(F.encode(piece, "UTF-8")), F.lit(SLOTS)).cast("int")
        return F.try_element_at(F.get(table, slot), piece)

    def step(parts: Column, _: Column) -> Column:
        last = F.size(parts)
        joined = F.zip_with(F.slice(parts, F.lit(1), last - 1), F.slice(parts, F.lit(2), last - 1), lambda a, b: F.concat(a, b))
        found = let(F.transform(joined, rank), lambda r: F.array_position(r, F.array_min(r)).cast("int"))

        def merged(at: Column) -> Column:
            return F.when(F.coalesce(at, F.lit(0)) == 0, parts).otherwise(F.concat(
                F.slice(parts, F.lit(1), at - 1), F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
                F.slice(parts, at + 2, F.greatest(last - at - 1, F.lit(0)))))

        return F.when(last < 2, parts).otherwise(let(found, merged))

    chars = F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")
    pieces = F.transform(F.sequence(F.lit(1), F.char_length(chars)), lambda i: F.substr(chars, i, F.lit(1)))
    folded = let(pieces, lambda p: F.aggregate(F.sequence(F.lit(1), F.size(p)), p, step))
    whole = rank(chars)
    return words.withColumn("ids", F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank)))


def dictionary(docs: DataFrame, pattern: str, ranks: dict[bytes, int], size: int = 1 << 16, sample_docs: int = 10_000,
               max_bytes: int = 48) -> dict[str, list[int]]:
    """Ids of the ``size`` most frequent words of at most ``max_bytes`` bytes,
    found in about ``sample_docs`` documents and folded by Spark. It only saves
    work: words outside it are encoded where they occur."""
    rows = docs.count()
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, rows // sample_docs))) == 0)
    words = chosen.select(F.explode(F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0))).alias("word"))
    frequent = (words.where(F.octet_length("word").between(1, max_bytes)).groupBy("word").count()
                .orderBy(F.desc("count"), "word").limit(size).select("word"))
    return {r["word"]: r["ids"] for r in fold_words(frequent.repartition(docs.sparkSession.sparkContext.defaultParallelism), ranks).collect()}


class Merges:
    """The same fold on arrays, for many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.letters = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                if (a := ranks.get(piece[:i])) is not None and (b := ranks.get(piece[i:])) is not None:
                    keys.append(a << 20 | b)
                    values.append(rank)
        order = np.argsort(keys)
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        self.none = np.int64(1 << 40)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's joined bytes (``none`` if they are no piece)."""
        wanted = a << np.int64(20) | b
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (a >= 0) & (b >= 0), self.values[at], self.none)

    def encode(self, words: list[bytes]) -> list[list[int]]:
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if w not in self.ranks and 1 < len(w) <= 32]
        for i, w in enumerate(words):
            if w in self.ranks:
                out[i] = [self.ranks[w]]
            elif len(w) > 32:
                out[i] = self.encode_long(w)
            elif not w:
                out[i] = []
        for a in range(0, len(short), 1 << 14):
            part = sorted(short[a:a + (1 << 14)], key=lambda i: len(words[i]))
            for b in range(0, len(part), 1 << 11):
                rows = part[b:b + (1 << 11)]
                for i, ids in zip(rows, self.fold([words[i] for i in rows])):
                    out[i] = ids
        return out

    def fold(self, words: list[bytes]) -> list[list[int]]:
        """Lock step: every round joins the lowest-ranked pair of each word."""
        width = max(map(len, words))
        size = np.array([len(w) for w in words])
        bytes_ = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        parts = np.where(np.arange(width) < size[:, None], self.letters[bytes_], -1)
        rank = self.joined(parts[:, :-1], parts[:, 1:])
        column = np.arange(width)
        rows = np.arange(len(words))
        final = [None] * len(words)
        while True:
            at = rank.argmin(axis=1)
            lowest = rank[np.arange(len(rows)), at]
            done = lowest == self.none
            if done.any():
                for r, p, n in zip(rows[done].tolist(), parts[done].tolist(), size[done].tolist()):
                    final[r] = p[:n]
                keep = ~done
                rows, parts, rank, size, at, lowest = rows[keep], parts[keep], rank[keep], size[keep], at[keep], lowest[keep]
                if not len(rows):
                    return final
            line = np.arange(len(rows))
            parts[line, at] = lowest
            behind = column[None, :-1] > at[:, None]
            parts[:, :-1] = np.where(behind, parts[:, 1:], parts[:, :-1])
            parts[:, -1] = -1
            rank[:, :-1] = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[:, -1] = self.none
            size = size - 1
            rank[line, at] = self.joined(parts[line, at], np.where(at + 1 < width, parts[line, np.minimum(at + 1, width - 1)], -1))
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.joined(parts[left, at[left] - 1], parts[left, at[left]])

    def encode_long(self, word: bytes) -> list[int]:
        """One long word, with a heap of its pairs."""
        get = self.ranks.get
        begin, end = list(range(len(word))), list(range(1, len(word) + 1))
        before, after = [i - 1 for i in begin], [i + 1 for i in begin]
        alive = [True] * len(word)
        heap = [(r, i, i + 2) for i in range(len(word) - 1) if (r := get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else len(word)
            if j >= len(word) or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < len(word):
                before[after[i]] = i
                if (r := get(word[i:end[after[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[i]]))
            if before[i] >= 0 and (r := get(word[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        return [self.ranks[word[i:end[i]]] for i in begin if alive[i]]


class Codec:
    """Encoder and decoder of a task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, frequent: dict[str, list[int]]):
        import regex
        self.frequent, self.merges, self.split = frequent, Merges(ranks), regex.compile(pattern)
        self.pieces = PieceEncoder(self.encode_words, lambda t: [i for ids in self.encode_words(self.split.findall(t)) for i in ids])
        held = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            held[rank] = piece
        self.size = np.array([len(p) for p in held], np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(held), np.uint8)

    def encode_words(self, words: list[str]) -> list:
        out: list = [self.frequent.get(w) for w in words]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.merges.encode([words[i].encode("utf-8", "surrogatepass") for i in rest])):
            out[i] = ids
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.pieces.encode(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        return gather(self.bytes, self.offset[ids], self.size[ids]).tobytes()


_CODECS: dict[str, Codec] = {}


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document row.

    The whole text is split by ``pattern``, each match encoded by the ranks of
    the file, and the ids decoded again. Null texts are empty (no ids);
    special tokens do not exist, their strings are ordinary text. Repeated
    rows stay; an empty table gives none.
    """
    spark = docs.sparkSession
    docs = required(docs, {"doc_id": "long", "text": "string"})
    ranks = read_ranks(ranks_path)
    sent = spark.sparkContext.broadcast((ranks, pattern, dictionary(docs, pattern, ranks)))
    schema = struct(doc_id="long", n_tokens="long", ids_sha256="string", decoded_sha256="string")
    name = f"{spark.sparkContext.applicationId}-{sent._jbroadcast.id()}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _CODECS:
            _CODECS.clear()
            _CODECS[name] = Codec(*sent.value)
        codec = _CODECS[name]
        for batch in batches:
            counts, ids_hash, text_hash = [], [], []
            for _, texts in text_slices(batch, "text"):
                for ids in codec.encode([t or "" for t in texts]):
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    text_hash.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()),
                                              pa.array(text_hash, pa.string())], names=schema.names)

    return docs.mapInArrow(scan, schema)
