"""Vectorised split of texts into the pieces of the byte-level BPE pattern.

The public split pattern is a regular expression; run character by character
it is the most expensive part of byte-level encoding. Here the split of a
whole run of texts is computed on arrays: character classes by table lookup,
piece starts from class changes, and one 64-bit hash per piece. Only the
distinct pieces are then handed to an encoder, and their ids are spread back
over all occurrences.

Characters whose class could differ between Unicode versions, and everything
above ``LIMIT``, are left to the encoder's own split: such texts are encoded
whole (``simple`` is False for them).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np

from tessera.llm.common import gather

LIMIT = 0x3000
OTHER, LETTER, NUMBER, SPACE, BLANK, END = 0, 1, 2, 3, 4, 5
#: Characters between two texts of a run.
SENTINEL = LIMIT
_WHITE = {0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F}
_UNSURE = {0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0x180E}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    old = unicodedata.ucd_3_2_0
    classes, sure = np.zeros(LIMIT + 1, np.uint8), np.zeros(LIMIT + 1, bool)
    for c in range(LIMIT):
        kind = unicodedata.category(chr(c))
        sure[c] = kind != "Cn" and kind == old.category(chr(c)) and c not in _UNSURE
        classes[c] = (SPACE if c == 0x20 else BLANK if c in _WHITE else LETTER if kind[0] == "L"
                      else NUMBER if kind[0] == "N" else OTHER)
    classes[SENTINEL] = END
    return classes, sure


CLASSES, SURE = _tables()
_RANDOM = np.random.default_rng(20240229)
_CODES = _RANDOM.integers(1, 2**63, LIMIT + 1, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def simple(text: str) -> bool:
    """Whether the vectorised split equals the pattern's on ``text``."""
    if text.isascii():
        return not any(c in text for c in "\x1c\x1d\x1e\x1f")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return bool(points.max() < LIMIT and SURE[points].all())


def starts(points: np.ndarray) -> np.ndarray:
    """Flags of the characters at which a piece begins; every ``SENTINEL`` is
    a piece of its own."""
    kind = CLASSES[points]
    white = (kind == SPACE) | (kind == BLANK)
    run = np.where(white, np.uint8(SPACE), kind)
    begin = np.empty(len(points), bool)
    begin[:1] = True
    np.not_equal(run[1:], run[:-1], out=begin[1:])
    begin |= kind == END
    # the last of the white-space characters before a word stands apart from the others; a blank joins the word
    after = np.flatnonzero(begin[1:] & white[:-1] & ~white[1:] & (kind[1:] != END)) + 1
    begin[after - 1] = True
    begin[after[points[after - 1] == 0x20]] = False
    # contractions
    for p in np.flatnonzero((points == 0x27) & begin):
        tail = points[p + 1:p + 3].tolist()
        size = 2 if tail and tail[0] in (115, 116, 109, 100) else 3 if tail in ([114, 101], [118, 101], [108, 108]) else 0
        if size:
            begin[p + 1] = False
            if size == 3:
                begin[p + 2] = False
            if p + size < len(points):
                begin[p + size] = True
    return begin


def hashes(points: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece's characters and length."""
    longest = int(length.max()) if len(length) else 1
    powers = np.cumprod(np.full(longest, _BASE, np.uint64))
    place = np.arange(len(points), dtype=np.int64) - np.repeat(begin, length)
    sums = np.add.reduceat(_CODES[points] * powers[place], begin)
    sums = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + length.astype(np.uint64)
    return sums ^ (sums >> np.uint64(32))


class PieceEncoder:
    """Encodes texts through a bounded cache of distinct pieces.

    ``encode_pieces`` gets distinct pieces and returns their ids;
    ``encode_text`` a whole text (for texts that are not ``simple``). The
    cache is emptied when it holds ``max_pieces`` pieces, so memory does not
    grow with the corpus.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list], encode_text: Callable[[str], list], max_pieces: int = 700_000):
        self.encode_pieces, self.encode_text, self.max_pieces = encode_pieces, encode_text, max_pieces
        self.clear()

    def clear(self):
        self.known: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.offset, self.size, self.pieces = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def add(self, keys: list[int], ids: list) -> None:
        need = self.used + sum(map(len, ids))
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need, 2 * len(self.flat)) - len(self.flat), np.uint32)])
        while self.pieces + len(keys) > len(self.size):
            self.offset, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.offset, self.size))
        for key, got in zip(keys, ids):
            self.flat[self.used:self.used + len(got)] = got
            self.offset[self.pieces], self.size[self.pieces] = self.used, len(got)
            self.known[key] = self.pieces
            self.pieces += 1
            self.used += len(got)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (uint32) of each text."""
        out: list = [None] * len(texts)
        easy = []
        for i, t in enumerate(texts):
            if not t:
                out[i] = np.zeros(0, np.uint32)
            elif simple(t):
                easy.append(i)
            else:
                out[i] = np.asarray(self.encode_text(t), np.uint32)
        if not easy:
            return out
        joined = chr(SENTINEL).join(texts[i] for i in easy) + chr(SENTINEL)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        begin = np.flatnonzero(starts(points))
        length = np.diff(np.append(begin, len(points)))
        ends = points[begin] == SENTINEL
        key, first, inverse = np.unique(hashes(points, begin, length), return_index=True, return_inverse=True)
        if self.pieces + len(key) > self.max_pieces:
            self.clear()
        keys = key.tolist()
        slot = [self.known.get(k, -1) for k in keys]
        new = [j for j, s in enumerate(slot) if s < 0]
        if new:
            pieces = []
            for j in new:
                a = begin[first[j]]
                pieces.append(joined[a:a + length[first[j]]])
            got = self.encode_pieces(["" if p == chr(SENTINEL) else p for p in pieces])
            self.add([keys[j] for j in new], got)
            for j in new:
                slot[j] = self.known[keys[j]]
        at = np.asarray(slot, np.int64)[inverse]
        size = self.size[at]
        ids = gather(self.flat, self.offset[at], size)
        cuts = np.cumsum(size)[ends]
        for i, part in zip(easy, np.split(ids, cuts[:-1])):
            out[i] = part
        return out
