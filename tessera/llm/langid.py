"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is
parsed against an automaton into phrases, each the longest match that occurs
in the labelled text; the fewer phrases, the closer the language. The
language with the smallest cross-parsing entropy (phrases times the bits of a
position in the labelled text, per character) is predicted.

The automata come from a bounded sample of labelled rows; every text is parsed
whole. Parsing runs in lock step over many pieces of texts at once, so a text
is cut into pieces of ``PIECE`` letters (a phrase ends at a cut).
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import required, struct, text_slices

PIECE = 1024
UNKNOWN, GAP = 0, 1


def suffix_automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions (state, symbol, next state) of the automaton of all
    substrings; state 0 is the start and no transition leads to it."""
    nexts, link, length = [{}], [-1], [0]
    last = 0
    for c in symbols:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    held = [(s, c, t) for s, out in enumerate(nexts) for c, t in out.items()]
    return tuple(np.array(held, np.int64).reshape(-1, 3).T)


class Transitions:
    """Transitions of an automaton: states x symbols in one array where that
    has at most ``dense`` cells, else a hash table with open addresses, whose
    size follows from the labelled text and not from the alphabet. Both give
    the same states."""

    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, state: np.ndarray, symbol: np.ndarray, to: np.ndarray, width: int, dense: int = 1 << 23):
        self.array, states = None, int(max(state.max(initial=0), to.max(initial=0))) + 1
        if states * width <= dense:
            self.width, self.array = width, np.zeros(states * width, np.int32)
            self.array[state * width + symbol] = to
            return
        self.width, self.bits = width, max(4, int(2 * len(state)).bit_length())
        self.keys, self.to = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        key = state * width + symbol
        slot, left = self.slots(key), np.arange(len(key))
        while len(left):
            at, who = np.unique(slot[left], return_index=True)
            free = self.keys[at] < 0
            self.keys[at[free]], self.to[at[free]] = key[left[who[free]]], to[left[who[free]]]
            left = np.delete(left, who[free])
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

    def slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * self.MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next states, 0 where there is no transition."""
        key = state * self.width + symbol
        if self.array is not None:
            return self.array[key]
        slot = self.slots(key)
        found = self.keys[slot]
        out = np.where(found == key, self.to[slot], 0)
        left = np.flatnonzero((found != key) & (found >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[left]]
            here = found == key[left]
            out[left[here]] = self.to[slot[left[here]]]
            left = left[~here & (found >= 0)]
        return out


class Model:
    """Symbols of characters, and per language an automaton and the bits of a
    phrase. ``samples``: language -> labelled texts; ``max_chars`` letters of
    each language are used. Every letter of the samples is a symbol of its own,
    whatever the script; a letter that a language's sample lacks matches
    nothing there."""

    def __init__(self, samples: dict[str, list[str]], max_chars: int = 24_000):
        self.langs = list(samples)
        joined = {lang: " ".join(samples[lang]).lower() for lang in self.langs}
        common = sorted({c for text in joined.values() for c in text if unicodedata.category(c)[0] == "L"})
        self.symbol = np.full(0x110000, GAP, np.int32)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] == "L":
                self.symbol[c] = UNKNOWN
        for k, c in enumerate(common):
            for same in {c, c.upper()}:
                if len(same) == 1:
                    self.symbol[ord(same)] = k + 2
        self.width = len(common) + 2
        self.tables, self.bits = [], []
        for lang in self.langs:
            symbols = self.symbols(joined[lang])[:max_chars]
            self.tables.append(Transitions(*suffix_automaton(symbols.tolist()), self.width))
            self.bits.append(math.log2(max(2, len(symbols))))

    def symbols(self, text: str) -> np.ndarray:
        """Symbols of a text: letters, and one gap between words."""
        got = self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = np.ones(len(got), bool)
        keep[1:] = (got[1:] != GAP) | (got[:-1] != GAP)
        return got[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text against each language (texts x languages)."""
        size = np.array([len(t) for t in texts], np.int64)
        pieces = -(-size // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        base = np.repeat(np.cumsum(size) - size, pieces)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = base + index * PIECE
        length = np.minimum(np.repeat(size, pieces) - index * PIECE, PIECE)
        order = np.argsort(-length, kind="stable")
        begin, length, owner = begin[order], length[order], owner[order]
        flat = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        lanes = np.searchsorted(-length, -np.arange(1, (int(length[0]) if len(length) else 0) + 1), side="right")
        out = np.zeros((len(texts), len(self.langs)))
        columns = [flat[begin[:k] + t] for t, k in enumerate(lanes)]
        for j, table in enumerate(self.tables):
            starts = table.follow(np.zeros(self.width, np.int64), np.arange(self.width))
            state, count = np.zeros(len(begin), np.int64), np.ones(len(begin), np.int64)
            for symbol in columns:
                k = len(symbol)
                to = table.follow(state[:k], symbol)
                missed = np.flatnonzero(to == 0)
                fresh = starts[symbol[missed]]
                to[missed] = fresh
                count[missed] += 1 + (fresh == 0)
                state[:k] = to
            out[:, j] = np.bincount(owner, count, len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """(language, score, entropy in bits per letter) of each text."""
        known = [self.symbols(t) if t else np.zeros(0, np.int32) for t in texts]
        letters = [bool(len(s)) and bool((s != GAP).any()) for s in known]
        use = [i for i, ok in enumerate(letters) if ok and self.langs]
        langs, scores, entropy = ["und"] * len(texts), [0.0] * len(texts), [float("nan")] * len(texts)
        if use:
            bits = self.phrases([known[i] for i in use]) * np.array(self.bits)
            for i, b in zip(use, bits):
                best = int(b.argmin())
                langs[i] = self.langs[best]
                scores[i] = float(1.0 / np.exp2(-(b - b[best]) / 8).sum())
                entropy[i] = float((b[best] - self.bits[best]) / len(known[i]))  # the last phrase is unfinished
        return langs, scores, entropy


def held_out(column: str = "doc_id"):
    """True where the CRC-32 of the id's decimal text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, max_chars: int = 24_000, docs_per_lang: int = 40) -> Model:
    """Model from at most ``docs_per_lang`` labelled documents of every label
    (the bound of the sample; a label's automaton takes a few MB at most), taken in the
    order of a hash of their ids from the rows that are not held out; of each,
    an excerpt at a hashed place, so that ``docs_per_lang`` excerpts hold about
    twice ``max_chars`` characters. Ties are decided for the label with more
    rows."""
    docs = required(docs, {"doc_id": "long", "text": "string", "lang": "string"})
    rows = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    named = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]  # one row a label
    size = -(-max_chars // docs_per_lang) * 2
    order = F.xxhash64("doc_id")
    begin = F.pmod(order, F.greatest(F.char_length("text") - size, F.lit(1)).cast("long")).cast("int") + 1
    window = Window.partitionBy("lang").orderBy(order, "doc_id")
    picked = (rows
              .select("lang", "doc_id", order.alias("at"), F.substring("text", begin, F.lit(size)).alias("text"))
              .withColumn("place", F.row_number().over(window)).where(F.col("place") <= docs_per_lang)
              .orderBy("at", "doc_id").collect()) if named else []
    return Model({lang: [r["text"] for r in picked if r["lang"] == lang] for lang in named}, max_chars)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None,
             names: tuple[str, str, str] = ("lang_pred", "score", "entropy")) -> DataFrame:
    """Columns ``keep`` (doc_id by default) with lang_pred, score, entropy,
    under other ``names`` where ``keep`` has columns of these.

    Only the text is looked at. ``lang_pred`` is ``und`` and score 0 where the
    text is null or has no letter, or no labelled text was given; entropy is
    NaN there. Repeated rows stay; an empty table gives none.
    """
    keep = keep or ["doc_id"]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep if c != "text"], F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    own = [f for f in docs.schema.fields if f.name != "text" or "text" in keep]
    schema = type(docs.schema)(own + struct(**dict(zip(names, ("string", "double", "double")))).fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch, f"c{at}", 1 << 21):
                found = sent.value.predict(texts)
                part = batch.slice(first, len(texts))
                columns = [c for i, c in enumerate(part.columns) if i != at or "text" in keep]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(found[0], pa.string()), pa.array(found[1], pa.float64()),
                                                            pa.array(found[2], pa.float64())], names=schema.names)

    required(docs, {})
    at = docs.columns.index("text")
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(scan, schema)  # any column names: by place
