"""Exact top-k inner-product search with a three-phase uniform threshold.

A vector's score is the sum of the partial scores of ``slices`` slices of its components. In a
tile (one block of queries against one block of candidates) each slice has a list of local
scores, taken above the slice's least score for the query, so that all are at least 0.

1. Each tile gathers the top k of each slice's list. Summed over the slices that an entry is
   known in, the k-th best sum over all tiles, tau, is a safe lower bound of the k-th best score.
2. The uniform cutoff tau / slices goes to every list: a candidate below it in every slice has
   a score below tau. Lists give their entries at or above it; the sum of a candidate's known
   entries plus the cutoff for each slice where it is unknown bounds its score from above.
3. Candidates whose bound reaches tau are resolved exactly from all their slices.

Tiles are what bounds memory: blocks have about ``query_block`` and ``block`` rows, dealt by a
hash of the id, and each tile is one group. Each phase shuffles k rows for a query and tile.
The result is exact; phase 1 decides only how much phase 3 has to resolve.

Edge cases: vectors that are null or hold null or non-finite components take no part, nor do
null ids; an id that repeats counts once, with its least vector; shorter vectors count 0 in the
components they lack; ties go to the smaller id; fewer than k candidates are all returned; an
empty table gives no rows. Scores are 64-bit integers (beyond that they wrap around).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.llm.common import materialise

LISTS = "query_id long, slice int, vec_id long, part long, least long"
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(df: DataFrame, vec_id: str, vec: str, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) for each component, one row per id, invalid ones left out."""
    x = F.col(vec).cast("array<double>")
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (df.where(F.col(vec_id).isNotNull() & x.isNotNull() & ~bad)
            .select(F.col(vec_id).cast("long").alias("vec_id"),
                    F.transform(x, lambda e: F.floor(e * scale)).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def _matrix(t: pa.Table, name: str, dims: int) -> np.ndarray:
    out = np.zeros((t.num_rows, dims), np.int64)
    for k, v in enumerate(t.column(name).to_pylist()):
        out[k, :len(v)] = v
    return out


def _tile(queries: pa.Table, candidates: pa.Table, slices: int):
    """(query ids, candidate ids sorted, partial scores [slice, query, candidate]) in parts."""
    dims = max([len(v) for t in (queries, candidates) for v in t.column("v").to_pylist()] or [0])
    qid = queries.column("vec_id").to_numpy()
    cid = candidates.column("vec_id").to_numpy()
    order = np.argsort(cid)
    cid, q = cid[order], _matrix(queries, "v", dims)
    c = _matrix(candidates, "v", dims)[order]
    peak = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(dims, 1)
    if peak < 2.0**53:  # exact in doubles, and much faster
        q, c = q.astype(np.float64), c.astype(np.float64)
    cuts = np.linspace(0, dims, slices + 1).astype(int)
    for lo in range(0, len(qid), 128):
        part = np.stack([(q[lo:lo + 128, a:b] @ c[:, a:b].T).astype(np.int64)
                         for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        yield lo, qid[lo:lo + 128], cid, part


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best allowed scores; ties to the earlier position."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        cut = np.partition(scores[at], len(at) - k)[len(at) - k]
        above = at[scores[at] > cut]
        at = np.concatenate([above, at[scores[at] == cut][:k - len(above)]])
    return at[np.lexsort((at, -scores[at]))]


def _gather(k: int, slices: int):
    def gather(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list[int]] = [[], [], [], [], []]
        if queries.num_rows and candidates.num_rows:
            for _, qid, cid, part in _tile(queries, candidates, slices):
                for i, q in enumerate(qid):
                    allowed = cid != q
                    if not allowed.any():
                        continue
                    for s in range(slices):
                        row = part[s, i]
                        best = _best(row, allowed, k)
                        least = int(row[allowed].min())
                        for col, v in zip(out, ([int(q)] * len(best), [s] * len(best),
                                                cid[best].tolist(), row[best].tolist(),
                                                [least] * len(best)), strict=True):
                            col += v
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                        names=["query_id", "slice", "vec_id", "part", "least"])
    return gather


def _resolve(k: int, slices: int):
    def resolve(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[list[int]] = [[], [], []]
        if queries.num_rows and candidates.num_rows:
            tau = queries.column("tau").to_numpy()
            least = np.array(queries.column("leasts").to_pylist(), np.int64).T  # [slice, query]
            for lo, qid, cid, part in _tile(queries, candidates, slices):
                for i, q in enumerate(qid):
                    above = part[:, i] - least[:, lo + i, None]
                    cutoff = tau[lo + i] / slices
                    sent = above >= cutoff
                    bound = np.where(sent, above, cutoff).sum(axis=0)
                    total = part[:, i].sum(axis=0)  # exact scores of those that are resolved
                    kept = sent.any(axis=0) & (bound >= tau[lo + i]) & (cid != q)
                    best = _best(total, kept, k)
                    out[0] += [int(q)] * len(best)
                    out[1] += cid[best].tolist()
                    out[2] += total[best].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out],
                        names=["query_id", "vec_id", "score"])
    return resolve


def _tiles(queries: DataFrame, candidates: DataFrame, fn, schema: str) -> DataFrame:
    """Apply ``fn`` to each pair of a query block and a candidate block."""
    return (queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb"))
            .applyInArrow(lambda q, c: fn(q, c), schema))


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5, vec_id: str = "vec_id",
          vec: str = "embedding", scale: int = 256, slices: int = 4, query_block: int = 4096,
          block: int = 2048) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest scores."""
    v = materialise(integer_vectors(vectors, vec_id, vec, scale), "vectors")
    n = v.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    qbs, cbs = _blocks(n.q, query_block), _blocks(n.n, block)
    deal = lambda m, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = v.where(is_query).withColumn("qb", deal(qbs, 1)).withColumn("cb", every(cbs))
    candidates = v.select(F.col("vec_id").alias("vec_id"), F.col("v").alias("v")) \
        .withColumn("cb", deal(cbs, 2)).withColumn("qb", every(qbs))

    lists = _tiles(queries, candidates, _gather(k, slices), LISTS)
    by_slice = Window.partitionBy("query_id", "slice")
    known = (lists.withColumn("least", F.min("least").over(by_slice))
             .withColumn("r", F.row_number().over(by_slice.orderBy(F.desc("part"), "vec_id")))
             .where(F.col("r") <= k))
    known = materialise(known, "topk-lists")  # k rows for a query and slice; read twice
    sums = known.groupBy("query_id", "vec_id").agg(
        F.sum(F.col("part") - F.col("least")).alias("known"))
    least = known.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_set(
        F.struct("slice", "least"))), lambda s: s["least"]).alias("leasts"))
    # fewer than k known entries: no cutoff
    taus = sums.groupBy("query_id").agg(F.sort_array(F.collect_list("known"), False).alias("t")) \
        .select("query_id", F.when(F.size("t") >= k, F.element_at("t", k)).otherwise(0)
                .alias("tau"))
    cutoffs = taus.join(least, "query_id").withColumnRenamed("query_id", "vec_id")

    found = _tiles(queries.join(cutoffs, "vec_id"), candidates, _resolve(k, slices), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
