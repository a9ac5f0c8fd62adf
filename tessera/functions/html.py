"""Repeated-record extraction from HTML stored in a table (inventory F14).

Spark has no HTML parser, so this is the one place where rows go through
Python: ``mapInPandas`` hands Arrow batches of pages to a small standard
library ``html.parser`` walker, one batch at a time, and emits one output row
per matched element. Pages are never grouped or collected; the work is spread
over the input partitions like a scan.

A record spec names a container element (tag and optional class) and the
fields to read inside each container: ``(tag, class or None, attribute or
None for the text, class-token index or None)``; the first matching
descendant wins. Text and attribute values are entity-decoded and stripped.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements that never have content or an end tag in HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}


def _matches(tag, attrs, want_tag, want_class):
    if tag != want_tag:
        return False
    if want_class is None:
        return True
    classes = (dict(attrs).get("class") or "").split()
    return all(c in classes for c in want_class.split())


class _RecordParser(HTMLParser):
    def __init__(self, container, fields):
        super().__init__(convert_charrefs=True)
        self.container = container
        self.fields = fields
        self.records: list[dict] = []
        self.depth = 0          # open elements inside the current container
        self.current = None     # dict of the record being read
        self.capturing = {}     # field -> [depth at open, text parts]

    def handle_starttag(self, tag, attrs):
        if self.current is None:
            if _matches(tag, attrs, *self.container):
                self.current = {}
                self.depth = 0 if tag in VOID else 1
                if tag in VOID:
                    self._close_record()
            return
        for name, (ftag, fcls, fattr, ftok) in self.fields.items():
            if name in self.current or name in self.capturing:
                continue
            if _matches(tag, attrs, ftag, fcls):
                if fattr is not None:
                    val = dict(attrs).get(fattr)
                    if val is not None and ftok is not None:
                        toks = val.split()
                        val = toks[ftok] if len(toks) > ftok else None
                    self.current[name] = val.strip() if isinstance(val, str) else val
                elif tag not in VOID:
                    self.capturing[name] = [self.depth + 1, []]
        if tag not in VOID:
            self.depth += 1

    def handle_endtag(self, tag):
        if self.current is None:
            return
        for name in list(self.capturing):
            d, parts = self.capturing[name]
            if self.depth == d:
                self.current[name] = "".join(parts).strip()
                del self.capturing[name]
        self.depth -= 1
        if self.depth <= 0:
            self._close_record()

    def handle_data(self, data):
        for _, parts in self.capturing.values():
            parts.append(data)

    def _close_record(self):
        for name, (_, parts) in self.capturing.items():
            self.current.setdefault(name, "".join(parts).strip())
        self.capturing = {}
        self.records.append(self.current)
        self.current = None
        self.depth = 0

    def parse_html_declaration(self, i):
        # "<![if x]>" is a comment up to ">" for browsers; the parser knows few keywords and ends at others
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i, 0)
        return super().parse_html_declaration(i)

    def close(self):
        super().close()
        if self.current is not None:
            self._close_record()


def parse_records(html: str, container, fields) -> list[dict]:
    p = _RecordParser(container, fields)
    p.feed(html or "")
    p.close()
    return p.records


def extract_records(df: DataFrame, html_col: str, key_cols, container: tuple,
                    fields: Mapping[str, tuple]) -> DataFrame:
    """One row per container element: ``(*key_cols, position, *fields)``.

    ``container`` is ``(tag, class or None)``; each field is ``(tag, class,
    attribute or None, token index or None)``. Positions count from 0 in
    document order, so keep-first dedup can use ``(key, position)``.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    fields = {k: tuple(v) + (None,) * (4 - len(v)) for k, v in fields.items()}
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType(key_fields + [T.StructField("position", T.IntegerType())] +
                          [T.StructField(f, T.StringType()) for f in fields])
    names = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = {k: [] for k in keys}
            out["position"] = []
            for f in names:
                out[f] = []
            for row in pdf.itertuples(index=False):
                recs = parse_records(getattr(row, html_col), container, fields)
                for i, r in enumerate(recs):
                    for k in keys:
                        out[k].append(getattr(row, k))
                    out["position"].append(i)
                    for f in names:
                        out[f].append(r.get(f))
            yield pd.DataFrame(out, columns=keys + ["position"] + names)

    from tessera.shipping import ensure_importable
    ensure_importable(df.sparkSession)
    return df.select(*keys, html_col).mapInPandas(run, schema)
