"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Words are lower-cased (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. A window is
``n`` consecutive words of a benchmark item; an item of fewer words, but not none, is one
window. The windows' hashes are broadcast; each document is scanned once in whole, hash hits
are verified word for word, and the words inside verified windows are marked.

Size of the broadcast: the benchmark is counted first and cut into parts of at most
``max_windows`` windows; each part is broadcast in turn and adds to the marks that the parts
before left with the document, so no part outgrows a worker however large the benchmark is.

Edge cases: null and empty texts have no words and no hits; null item texts and items
without words are passed over; items that repeat an id count once; repeated documents are
judged row by row; an empty benchmark hits nothing. Result columns replace input columns of
the same name.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.llm.common import WORD_BYTES, materialise, with_columns, words

MARKS = [T.StructField("_ranges", T.ArrayType(T.IntegerType())),
         T.StructField("_items", T.ArrayType(T.StringType())),
         T.StructField("_n_words", T.LongType()), T.StructField("_n_hit", T.LongType())]
MARK_NAMES = [f.name for f in MARKS]


class WindowSet:
    """Windows of benchmark items: word ids, and by length the windows' items."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.ids: dict[bytes, int] = {}
        self.by_length: dict[int, dict[tuple, set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ws = [self.ids.setdefault(w, len(self.ids) + 1) for w in words(text)]
            length = min(n, len(ws))
            for i in range(len(ws) - length + 1 if ws else 0):
                self.by_length[length][tuple(ws[i:i + length])].add(item)
        self.by_length = {k: dict(v) for k, v in self.by_length.items()}
        rng = np.random.default_rng(1)
        self.mix = rng.integers(1, 2**63, n, dtype=np.uint64) | np.uint64(1)
        self.hashes = {k: np.unique(self._hash(np.array(list(v), np.uint64)))
                       for k, v in self.by_length.items()}

    def _hash(self, rows: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (rows * self.mix[:rows.shape[1]]).sum(axis=1, dtype=np.uint64)

    def hits(self, ws: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(start, length, item ids) of every window that occurs in the words."""
        ids = np.fromiter(map(self.ids.get, ws, repeat(0)), np.uint64, len(ws))
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for length, windows in self.by_length.items():
            if len(ids) < length:
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            for lo in range(0, len(at), 65536):
                part = at[lo:lo + 65536]
                rows = ids[part[:, None] + np.arange(length)]
                for k in np.flatnonzero(np.isin(self._hash(rows), self.hashes[length])):
                    found = windows.get(tuple(int(x) for x in rows[k]))
                    if found:
                        yield int(part[k]), length, found


def _merge(ranges: list[tuple[int, int]]) -> list[int]:
    """Half-open ranges, united and flattened: start, end, start, end, ..."""
    out: list[int] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1]:
            out[-1] = max(out[-1], hi)
        else:
            out += [lo, hi]
    return out


def _scan(windows, text: str, keep: list[str]):
    """mapInArrow function: adds one part's hits to the marks of each document."""
    def scan(batches):
        ws = windows.value
        for b in batches:
            col = {name: b.column(k) for k, name in enumerate(b.schema.names)}
            out = []
            for t, r, items in zip(col[text].to_pylist(), col["_ranges"].to_pylist(),
                                   col["_items"].to_pylist(), strict=True):
                ranges, found = list(zip(r[::2], r[1::2], strict=True)), set(items)
                own = words(t)
                for start, length, hit in ws.hits(own):
                    ranges.append((start, start + length))
                    found |= hit
                flat = _merge(ranges)
                out.append((flat, sorted(found), len(own), sum(flat[1::2]) - sum(flat[::2])))
            new = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(
                (pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(col[c] for c in keep), *new],
                                             names=keep + MARK_NAMES)
    return scan


def mark(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
         item_text: str = "text", n: int = 13, max_windows: int = 2_000_000) -> DataFrame:
    """``docs`` with ``_ranges`` (hit word ranges, flattened), ``_items`` (ids as text, sorted),
    ``_n_words`` and ``_n_hit``."""
    spark = docs.sparkSession
    items = benchmark.where(F.col(item_text).isNotNull() & F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("words"))
    # an item has no more windows than half its characters
    size = items.agg(F.sum(F.length("words"))).first()[0] or 0
    parts = max(1, -(-size // (2 * max_windows)))
    out = docs.drop(*MARK_NAMES)
    keep = out.columns
    schema = with_columns(out.schema, MARKS)
    out = out.select("*", F.array().cast("array<int>").alias("_ranges"),
                     F.array().cast("array<string>").alias("_items"))
    for p in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == p).collect()
        windows = spark.sparkContext.broadcast(WindowSet([(r.item, r.words) for r in rows], n))
        out = out.mapInArrow(_scan(windows, text, keep), schema)
        if p + 1 < parts:
            out = materialise(out, "decontaminate")
    return out


def measure(docs: DataFrame, benchmark: DataFrame, *, text: str = "text",
            min_share: int = 20, **kw) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    A document is contaminated when n_hit > 0 and ``min_share`` * n_hit >= n_words.
    """
    new = {"n_words": F.col("_n_words"), "n_hit": F.col("_n_hit"),
           "n_items": F.size("_items").cast("long"),
           "items_sha256": F.sha2(F.array_join("_items", ",").cast("binary"), 256),
           "contaminated": (F.col("_n_hit") > 0)
           & (F.col("_n_hit") * min_share >= F.col("_n_words"))}
    marked = mark(docs, benchmark, text=text, **kw)
    old = [c for c in marked.columns if c not in MARK_NAMES and c.lower() not in new]
    return marked.select(*[F.col(f"`{c}`") for c in old], *[v.alias(k) for k, v in new.items()])


def remove_spans(text: str | None, ranges: list[int]) -> str | None:
    """The text without the words of the flattened word ranges (and what lies between them)."""
    if not text or not ranges:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    flat = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flat.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    out, at = [], 0
    for lo, hi in zip(ranges[::2], ranges[1::2], strict=True):
        out.append(raw[at:starts[lo]])
        at = ends[hi - 1]
    out.append(raw[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents",
                  text: str = "text", min_share: int = 20, **kw) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``), or with the hit
    words cut out of every text (``remove="spans"``); columns as they were."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    marked = mark(docs, benchmark, text=text, **kw)
    if remove == "documents":
        hit = (F.col("_n_hit") > 0) & (F.col("_n_hit") * min_share >= F.col("_n_words"))
        return marked.where(~hit).select(*[F.col(f"`{c}`") for c in docs.columns])

    names = docs.columns

    def cut(batches):
        for b in batches:
            col = {name: b.column(k) for k, name in enumerate(b.schema.names)}
            col[text] = pa.array([remove_spans(t, r) for t, r in zip(
                col[text].to_pylist(), col["_ranges"].to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([col[c] for c in names], names=names)

    return marked.mapInArrow(cut, docs.schema)
