"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed where the documents are. A bounded sample of labelled
rows (``fit_rows``, the documented limit of the fit) trains the trees: each feature is cut into
quantile bins, and every split is found on histograms of gradients and Hessians (logistic loss).
The fitted trees are flattened into arrays (feature, threshold, left, right, value), and a batch of
documents walks all trees at once in numpy, one vector step for each level.

Edge cases: null and empty texts have all statistics 0 and get the score of such a row; labels
that are null or not 0/1 are left out; a document with several labels counts with their larger
one; without any labelled rows, or with one class only, the score is the share of label 1 (0.5 if
there are none); repeated documents are scored row by row.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ("log_chars", "log_words", "word_length", "line_length", "upper", "digits", "symbols",
            "punctuation", "white", "non_ascii", "distinct_words", "top_word", "repeat_next",
            "distinct_lines", "top_line", "symbol_words", "upper_words", "long_words",
            "short_words", "sentence_ends", "entropy")


def _byte_classes() -> np.ndarray:
    c = np.zeros(256, np.int64)
    for b in range(256):
        ch = chr(b)
        c[b] = (1 if b > 127 else 2 if ch.isupper() else 3 if ch.isdigit() else 4 if ch.isspace()
                else 5 if ch in ".,;:!?'\"()-" else 6 if not ch.isalpha() else 0)
    return c


CLASS = _byte_classes()


def statistics(text: str | None) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(CLASS, weights=bytes_, minlength=7) / n
    ws = raw.split()
    m = max(1, len(ws))
    counts = Counter(ws)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    line_counts = Counter(lines)
    same = sum(a == b for a, b in zip(ws, ws[1:], strict=False))
    sizes = np.fromiter(map(len, ws), np.int64, len(ws))
    p = bytes_[bytes_ > 0] / n
    upper = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    symbol = sum(c for w, c in counts.items() if CLASS[w[-1]] == 6 or w[-2:] == b"!!")
    top_line = max((len(x) * c for x, c in line_counts.items() if c > 1), default=0)
    ends = bytes_[ord(".")] + bytes_[ord("!")] + bytes_[ord("?")]
    return [np.log1p(n), np.log1p(len(ws)), n / m, n / max(1, len(lines)), kinds[2], kinds[3],
            kinds[6], kinds[5], kinds[4], kinds[1], len(counts) / m,
            max(counts.values(), default=0) / m, same / m, len(line_counts) / max(1, len(lines)),
            top_line / n, symbol / m, upper / m, float((sizes > 12).sum()) / m,
            float((sizes <= 3).sum()) / m, ends / m, float(-(p * np.log2(p)).sum())]


@dataclass
class Trees:
    """Flattened trees: nodes of all trees in one set of arrays; a leaf points at itself."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        for _ in range(self.depth if len(self.roots) else 0):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        if len(self.roots):
            out += self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 80, depth: int = 4, bins: int = 64,
        rate: float = 0.15, l2: float = 1.0, min_rows: int = 10) -> Trees:
    """Histogram gradient boosting with logistic loss; deterministic."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4))
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    base = float(np.log(share / (1 - share)))
    if len(y) and 0 < y.mean() < 1:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]))
                 for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)])
        raw = np.full(len(y), base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, p * (1 - p)
            roots.append(_grow(nodes, binned, edges, grad, hess, np.arange(len(y)), depth, bins,
                               rate, l2, min_rows, raw))
    a = np.array(nodes).reshape(-1, 5)
    return Trees(base, np.array(roots, np.int64), a[:, 0].astype(np.int64), a[:, 1],
                 a[:, 2].astype(np.int64), a[:, 3].astype(np.int64), a[:, 4], depth)


def _grow(nodes, binned, edges, grad, hess, rows, depth, bins, rate, l2, min_rows, raw) -> int:
    me = len(nodes)
    g, h = grad[rows].sum(), hess[rows].sum()
    nodes.append([0, 0.0, me, me, rate * g / (h + l2)])
    best = (1e-6, -1, 0)
    if depth and len(rows) >= 2 * min_rows:
        for j in range(len(binned)):
            b = binned[j, rows]
            gl = np.cumsum(np.bincount(b, weights=grad[rows], minlength=bins))[:-1]
            hl = np.cumsum(np.bincount(b, weights=hess[rows], minlength=bins))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=bins))[:-1]
            gain = gl**2 / (hl + l2) + (g - gl)**2 / (h - hl + l2) - g**2 / (h + l2)
            gain[(nl < min_rows) | (len(rows) - nl < min_rows)] = 0
            gain = gain[:len(edges[j])]
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), j, int(gain.argmax()))
    if best[1] < 0:
        raw[rows] += nodes[me][4]
        return me
    _, j, cut = best
    goes_left = binned[j, rows] <= cut
    args = (grad, hess)
    lo = _grow(nodes, binned, edges, *args, rows[goes_left], depth - 1, bins, rate, l2, min_rows,
               raw)
    hi = _grow(nodes, binned, edges, *args, rows[~goes_left], depth - 1, bins, rate, l2, min_rows,
               raw)
    nodes[me][:4] = [j, float(edges[j][cut]), lo, hi]
    return me


def _features(batch: pa.RecordBatch, at: int) -> np.ndarray:
    rows = [statistics(t) for t in batch.column(at).to_pylist()]
    return np.array(rows, np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, learn: Column, *, doc_id: str = "doc_id",
          text: str = "text", label: str = "quality", fit_rows: int = 20_000, **kw) -> Trees:
    """Trees fitted on at most ``fit_rows`` labelled rows: those whose id hashes lowest, with one
    text of each id (where an id repeats with several, the one that hashes lowest)."""
    marks = (labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("l_id")).agg(F.max(label).cast("double").alias("y")))
    order = F.xxhash64("l_id", F.lit(17))
    cut = marks.select(F.col("l_id").alias(doc_id), "l_id", "y").where(learn)
    last = cut.select(order.alias("h")).orderBy("h").limit(fit_rows).agg(F.max("h")).first()[0]
    if last is None:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0), **kw)
    chosen = cut.where(order <= last).select("l_id", "y")
    rows = docs.select(F.col(doc_id).alias("d_id"), F.col(text).alias("t")).join(
        chosen, F.col("d_id") == F.col("l_id")).groupBy("d_id", "y").agg(
        F.min_by("t", F.xxhash64("t")).alias("t")).select("d_id", "t", "y")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(_features(b, 1)), pa.list_(pa.float64())),
                 b.column(2)], names=["id", "x", "y"])

    kind = dict(rows.dtypes)["d_id"]
    t = rows.mapInArrow(run, f"id {kind}, x array<double>, y double").toArrow().sort_by("id")
    x = np.array(t.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, t.column("y").to_numpy(), **kw)


def predict(docs: DataFrame, trees: Trees, *, text: str = "text", cut: float = 0.3) -> DataFrame:
    """``docs`` without the text, with score and predicted."""
    model = docs.sparkSession.sparkContext.broadcast(trees)  # rounds * 2**(depth + 1) nodes at most
    # the other columns as one, so that their names do not matter
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (text, "score", "predicted")])
    rows = docs.select(row.alias("row"), F.col(text).alias("t"))
    schema = rows.select("row").schema.add("score", "double").add("predicted", "integer")

    def run(batches):
        for b in batches:
            s = model.value.score(_features(b, 1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= cut).astype(np.int32))],
                names=["row", "score", "predicted"])

    return rows.mapInArrow(run, schema).select("row.*", "score", "predicted")
