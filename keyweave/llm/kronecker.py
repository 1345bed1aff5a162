"""Hard negatives by Kronecker-packed products.

A vector is floor(scale * x) in each component; a row's score for an anchor is the integer inner
product. An anchor's positives are its best other rows of the same label; for each anchor and
positive, the negatives are the best rows of another label whose score lies between two shares of
the positive's score.

Scores are computed for a block of candidates at once. Components are biased by the least one of
the table, so that all are at least 0, and for each dimension the components of all candidates
of the block lie side by side in fields of one wide integer. An anchor's biased component is
multiplied with that integer once, and the products are added up over the dimensions: the fields
are as wide as the largest sum, so none carries into the next. The fields are then unpacked and
the biases taken off, which gives the exact scores of all candidates of the block.

Two passes over tiles of an anchor block and a candidate block: the positives (blocks are made
by a hash of the label, so only those of the anchor's label hash are met), then the negatives
over all blocks, with each anchor's positives at hand. A tile returns a few rows for an anchor.

Edge cases: rows with a null label, id or vector or with a null or non-finite component take no
part; rows with equal ids are rows of their own, an anchor leaves out only its own row; missing
components of shorter vectors count 0; ties go to the smaller id; fewer rows are all returned;
an anchor without positives gives none; an empty table gives none. Components and scores are
64-bit integers, larger ones are held at the ends of that range. Very long vectors make blocks
of fewer rows. Other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.llm.blocks import best, blocks_of, deal, every, matrix, numbered, tiles
from keyweave.llm.common import materialise

BLOCK = "cb int, lh int, rids binary, ids binary, labels binary, wide array<binary>"
POSITIVE = "rid long, vec_id long, score long"
NEGATIVE = "rid long, p int, vec_id long, score long"
LONG = 2**63 - 1  # scores beyond it, or below its negative, are held there


class Fields:
    """The packing of a table's components: bias, dimensions and bytes of a field."""

    def __init__(self, least: int, most: int, dims: int):
        self.bias = max(0, -least)
        self.dims = dims
        top = max(0, most) + self.bias
        self.bytes = max(1, -(-(dims * top * top).bit_length() // 8))

    def biased(self, x: np.ndarray) -> np.ndarray:
        """Components + bias as unsigned integers; exact, since the sum is below 2**64."""
        with np.errstate(over="ignore"):
            return x.astype(np.uint64) + np.uint64(self.bias)

    def pack(self, x: np.ndarray) -> list[bytes]:
        """For each dimension the biased components of all rows, a field each."""
        own = np.ascontiguousarray(self.biased(x).T).astype("<u8").view(np.uint8)
        out = np.zeros((self.dims, len(x), self.bytes), np.uint8)
        n = min(8, self.bytes)
        out[:, :, :n] = own.reshape(self.dims, len(x), 8)[:, :, :n]
        return [row.tobytes() for row in out]

    def unpack(self, wide: int, n: int) -> np.ndarray:
        """The n fields of an integer: int64, or Python integers where fields have 8 bytes or more."""
        raw = wide.to_bytes(n * self.bytes, "little")
        if self.bytes >= 8:
            b = self.bytes
            return np.array([int.from_bytes(raw[i:i + b], "little")
                             for i in range(0, len(raw), b)], object)
        out = np.zeros((n, 8), np.uint8)
        out[:, :self.bytes] = np.frombuffer(raw, np.uint8).reshape(n, self.bytes)
        return out.view("<i8").ravel().astype(np.int64)


class Packed:
    """A block of candidates as wide integers."""

    def __init__(self, fields: Fields, wide: list[bytes], n: int):
        self.fields, self.n = fields, n
        self.wide = [int.from_bytes(w, "little") for w in wide]
        self.sums = fields.unpack(sum(self.wide), n)  # of each candidate's biased components

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of one anchor (biased components) with all candidates."""
        f, total, own = self.fields, 0, 0
        for a, w in zip(anchor.tolist(), self.wide, strict=True):
            total += a * w
            own += a
        s = f.unpack(total, self.n) - f.bias * self.sums + (f.dims * f.bias - own) * f.bias
        if s.dtype == object:
            s = np.array([max(-LONG, min(LONG, x)) for x in s], np.int64)
        return s


def _pack(fields: Fields):
    def pack(rows: pa.Table) -> pa.Table:
        x = matrix(rows.column("v"), fields.dims, np.int64)
        as_bytes = lambda c: rows.column(c).to_numpy().astype("<i8").tobytes()
        return pa.table({
            **{c: pa.array([rows.column(c)[0].as_py()], pa.int32()) for c in ("cb", "lh")},
            "rids": pa.array([as_bytes("rid")], pa.binary()),
            "ids": pa.array([as_bytes("vec_id")], pa.binary()),
            "labels": pa.array([as_bytes("label")], pa.binary()),
            "wide": pa.array([fields.pack(x)], pa.list_(pa.binary()))})
    return pack


def _opened(block: pa.Table, fields: Fields):
    """(row numbers, ids, labels, packed block) of each block row."""
    for row in block.to_pylist():
        rids, ids, labels = (np.frombuffer(row[c], "<i8") for c in ("rids", "ids", "labels"))
        yield rids, ids, labels, Packed(fields, row["wide"], len(rids))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split() for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(names, columns, strict=True)})


def _positives(fields: Fields, k: int):
    def positives(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        own = fields.biased(matrix(anchors.column("v"), fields.dims, np.int64))
        for rids, ids, labels, packed in _opened(block, fields):
            for a, rid, label in zip(own, anchors.column("rid").to_pylist(),
                                     anchors.column("label").to_pylist(), strict=True):
                at = np.flatnonzero((labels == label) & (rids != rid))
                if len(at):
                    s = packed.scores(a)
                    out += [(rid, int(ids[i]), int(s[i])) for i in best(s, ids, at, k)]
        return _table(out, POSITIVE)
    return positives


def _negatives(fields: Fields, k: int, low: int, high: int, per: int):
    def negatives(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        own = fields.biased(matrix(anchors.column("v"), fields.dims, np.int64))
        for rids, ids, labels, packed in _opened(block, fields):
            for a, rid, label, scores in zip(
                    own, anchors.column("rid").to_pylist(), anchors.column("label").to_pylist(),
                    anchors.column("scores").to_pylist(), strict=True):
                s, other = packed.scores(a), labels != label
                for p, score in enumerate(scores):
                    # per * s >= low * score and per * s <= high * score, in whole numbers
                    least, most = -(-low * score // per), high * score // per
                    at = np.flatnonzero(other & (s >= least) & (s <= most))
                    out += [(rid, p, int(ids[i]), int(s[i])) for i in best(s, ids, at, k)]
        return _table(out, NEGATIVE)
    return negatives


def hard_negatives(vectors: DataFrame, is_anchor: Column, *, positives: int = 5,
                   negatives: int = 5, low: int = 80, high: int = 100, per: int = 100,
                   vec_id: str = "vec_id", vec: str = "embedding", label: str = "label",
                   scale: int = 256, anchor_block: int = 1024, block: int = 8192,
                   label_hashes: int = 16) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Negatives satisfy low * positive_score <= per * negative_score <= high * positive_score.
    ``is_anchor`` is read on the input's columns. ``block`` is the rows of a candidate block of
    vectors of at most 256 components; longer ones make it smaller.
    """
    v = numbered(vectors.where(F.col(label).isNotNull()), vec_id, vec, "labelled-vectors",
                 label=F.col(label).cast("long"), anchor=F.coalesce(is_anchor, F.lit(False)))
    v = v.withColumn("v", F.transform("v", lambda e: F.floor(e * scale))).withColumn(
        "lh", F.pmod(F.xxhash64("label"), F.lit(label_hashes)).cast("int"))
    seen = {r.lh: r for r in v.groupBy("lh").agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("a"), F.max(F.size("v")).alias("dims"),
        F.min(F.array_min("v")).alias("least"), F.max(F.array_max("v")).alias("most")).collect()}
    fields = Fields(min([r.least for r in seen.values() if r.least is not None], default=0),
                    max([r.most for r in seen.values() if r.most is not None], default=0),
                    max([r.dims for r in seen.values()], default=0))
    block = max(64, block * 256 // max(256, fields.dims))
    count = [seen[h].n if h in seen else 0 for h in range(label_hashes)]
    anchors = [seen[h].a if h in seen else 0 for h in range(label_hashes)]

    def laid(rows: list[int], size: int) -> tuple[Column, Column, int]:
        """First block and number of blocks of a label hash; blocks of all."""
        n = [blocks_of(r, size) for r in rows]
        of = lambda x: F.element_at(F.array(*map(F.lit, x)), F.col("lh") + 1)
        return of([sum(n[:i]) for i in range(len(n))]), of(n), sum(n)

    first, blocks, cbs = laid(count, block)
    a_first, a_blocks, _ = laid(anchors, anchor_block)
    spread = lambda seed, n: F.pmod(F.xxhash64("rid", F.lit(seed)), n).cast("int")
    packed = materialise(v.withColumn("cb", first + spread(1, blocks)).groupBy("cb").applyInArrow(
        _pack(fields), BLOCK), "kronecker-blocks")
    is_a = v.where("anchor").select("rid", "vec_id", "label", "lh", "v")

    # positives: the blocks of the anchor's label hash
    near = packed.withColumn("qb", F.explode(F.sequence(a_first, a_first + a_blocks - 1)))
    asking = is_a.withColumn("qb", a_first + spread(2, a_blocks)).withColumn(
        "cb", F.explode(F.sequence(first, first + blocks - 1)))
    found = tiles(asking, near, _positives(fields, positives), POSITIVE)
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id"))
    found = materialise(found.withColumn("r", rank).where(F.col("r") <= positives),
                        "kronecker-positives")

    # negatives: all blocks, with the positives of each anchor
    qbs = blocks_of(sum(anchors), anchor_block)
    of_anchor = found.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("r", "score"))).alias("s"))
    asking = is_a.join(of_anchor.select("rid", F.col("s.score").alias("scores")), "rid") \
        .withColumn("qb", deal(qbs, 3)).withColumn("cb", every(cbs))
    out = tiles(asking, packed.withColumn("qb", every(qbs)),
                _negatives(fields, negatives, low, high, per), NEGATIVE)
    rank = F.row_number().over(Window.partitionBy("rid", "p").orderBy(F.desc("score"), "vec_id"))
    out = out.withColumn("rank", rank.cast("int")).where(F.col("rank") <= negatives).select(
        "rid", (F.col("p") + 1).alias("r"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return (out.join(found.select("rid", "r", F.col("vec_id").alias("positive_id"),
                                  F.col("score").alias("positive_score")), ["rid", "r"])
            .join(is_a.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
