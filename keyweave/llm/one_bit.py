"""Approximate nearest neighbours from randomly rotated one-bit codes.

Vectors are taken from the mean c of all rows, o = c + n * u with a unit vector u, and u is rotated
by a random orthonormal matrix into ``bits`` dimensions. The code is the signs of the rotated
vector, one bit each; with the unit vector s of these signs and the correction scalar
a = <s, rotated u>, the inner product with a query q is estimated as

    <q, c> + n * <s, rotated q> / a,

with an error of about |q| * n * sqrt(1 - a**2) / (a * sqrt(bits - 1)) (one standard deviation,
for a random rotation). Only candidates whose estimate plus ``errors`` such deviations reaches the
k-th best exact score known so far are scored on the original vectors.

Every row is coded, in blocks of packed bits, scalars and vectors, each a few rows of bounded size;
a tile of a query block and a code block takes them one by one and its queries in slices, so what
it holds beside its input does not grow with either, and returns at most k rows for a query. Nothing is fitted on a sample. The rotation is
random (``seed``), so a neighbour is missed with the small chance that an error exceeds its
bound; scores are exact: products added in double precision in the order of the components.

Edge cases: rows with a null id, a null, empty or zero vector or a null or non-finite component
take no part; rows with equal ids are rows of their own, a query leaves out only its own row;
shorter vectors count 0 in the components they lack; ties go to the smaller id; fewer candidates
are all returned; an empty table gives no rows. Very long vectors make blocks of fewer rows.
Other input columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.llm.blocks import blocks_of, deal, every, matrix, numbered, tiles

CODES = "cb int, rids binary, ids binary, signs binary, norms binary, cosines binary, vectors binary"
FOUND = "rid long, vec_id long, score double"
CHUNK = 4096  # codes unpacked at a time
QUERIES = 128  # queries estimated at a time
CODES_A_ROW = 8192  # at most
TILES = 64  # query blocks grow up to 8 times while there are more


def rotation(dims: int, bits: int, seed: int) -> np.ndarray:
    """Orthonormal columns: a random rotation of ``dims`` dimensions into ``bits``."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dims)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, centre: np.ndarray, rotate: np.ndarray):
    """(packed signs, distances from the centre, correction scalars) of the rows of ``x``."""
    o = x - centre
    norms = np.sqrt((o * o).sum(axis=1))
    u = (o / np.where(norms == 0, 1, norms)[:, None]) @ rotate.T
    cosines = np.abs(u).sum(axis=1) / np.sqrt(rotate.shape[0])
    return np.packbits(u >= 0, axis=1), norms, np.where(norms == 0, 1, cosines)


def dots(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of q[i] and x[j] (one dimension a row), added in the order of dimensions."""
    out = np.zeros(len(i))
    for a, b in zip(q, x, strict=True):
        out += a[i] * b[j]
    return out


class Best:
    """The k best (score, id) of each of m queries so far."""

    def __init__(self, m: int, k: int):
        self.m, self.k = m, k
        self.query, self.id = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score = np.empty(0)

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        q = np.concatenate([self.query, query])
        i, s = np.concatenate([self.id, ids]), np.concatenate([self.score, scores])
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < self.k
        self.query, self.id, self.score = q[kept], i[kept], s[kept]

    def least(self) -> np.ndarray:
        """The k-th best score of each query; -inf while there are fewer."""
        out = np.full(self.m, -np.inf)
        n = np.bincount(self.query, minlength=self.m)
        out[n >= self.k] = self.score[np.cumsum(n)[n >= self.k] - 1]
        return out


def scan(q: np.ndarray, q_rids: np.ndarray, block: dict, centre: np.ndarray, rotate: np.ndarray,
         k: int, errors: float, so_far: list[Best] | None = None) -> tuple[Best, int]:
    """Best neighbours of the queries in one code block; how many were scored exactly. ``so_far``
    keeps the best of each ``QUERIES`` queries from block to block."""
    bits = rotate.shape[0]
    slices = [slice(lo, lo + QUERIES) for lo in range(0, len(q), QUERIES)]
    best, scored = [] if so_far is None else so_far, 0
    if not best:
        best += [Best(len(q[s]), k) for s in slices]
    turned = (q @ rotate.T / np.sqrt(bits)).astype(np.float32)
    base, length = q @ centre, np.sqrt((q * q).sum(axis=1))
    far = np.sqrt((centre * centre).sum())
    for lo in range(0, len(block["rids"]), CHUNK):
        rids, ids, packed, norms, cosines, x = (
            block[c][lo:lo + CHUNK] for c in ("rids", "ids", "signs", "norms", "cosines", "vectors"))
        signs = np.unpackbits(packed, axis=1, count=bits).astype(np.float32) * 2 - 1
        spread = norms * np.sqrt(np.maximum(0, 1 - cosines**2)) / cosines / np.sqrt(max(1, bits - 1))
        xt = np.ascontiguousarray(x.T)
        for s, found in zip(slices, best, strict=True):
            qt = np.ascontiguousarray(q[s].T)
            estimate = base[s, None] + turned[s] @ signs.T * (norms / cosines)
            own = q_rids[s, None] == rids
            estimate[own] = -np.inf
            # the k best estimates give a first threshold (or a better one)
            if len(rids) > k:
                j = np.argpartition(-estimate, k - 1, axis=1)[:, :k]
                i = np.repeat(np.arange(found.m), k)
                first = np.where(own[i, j.ravel()], -np.inf, dots(qt, xt, i, j.ravel()))
                least = np.maximum(found.least(), first.reshape(-1, k).min(axis=1))
            else:
                least = found.least()
            slack = 1e-5 * (length[s, None] * (norms + far))
            bound = estimate + errors * length[s, None] * spread + slack
            i, j = np.nonzero((bound >= least[:, None]) & ~own)
            scored += len(i)
            found.add(i, ids[j], dots(qt, xt, i, j))
    return joined(best, k), scored


def joined(best: list[Best], k: int) -> Best:
    """The best of all queries from those of their slices."""
    out = Best(sum(b.m for b in best), k)
    if best:
        out.query = np.concatenate([b.query + QUERIES * n for n, b in enumerate(best)])
        out.id, out.score = (np.concatenate([getattr(b, c) for b in best]) for c in ("id", "score"))
    return out


def _encode(dims: int, centre: np.ndarray, rotate: np.ndarray):
    def rows(t: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("rids", "ids", "signs", "norms", "cosines", "vectors")}
        for lo in range(0, len(t), CODES_A_ROW):
            part = t.slice(lo, CODES_A_ROW)
            x = matrix(part.column("v"), dims)
            codes = [encode(x[i:i + 1024], centre, rotate) for i in range(0, len(x), 1024)]
            signs, norms, cosines = (np.concatenate(c) for c in zip(*codes, strict=True))
            raw = {"rids": part.column("rid").to_numpy().astype("<i8"),
                   "ids": part.column("vec_id").to_numpy().astype("<i8"), "signs": signs,
                   "norms": norms, "cosines": cosines, "vectors": x}
            for n, a in raw.items():
                out[n].append(a.tobytes())
        return pa.table({"cb": t.column("cb")[:len(out["rids"])],
                         **{n: pa.array(a, pa.binary()) for n, a in out.items()}})
    return rows


def opened(row: dict, dims: int) -> dict:
    """The arrays of a code block's row."""
    out = {c: np.frombuffer(row[c], "<i8") for c in ("rids", "ids")}
    out |= {c: np.frombuffer(row[c], np.float64) for c in ("norms", "cosines")}
    n = len(out["rids"])
    out["signs"] = np.frombuffer(row["signs"], np.uint8).reshape(n, -1)
    out["vectors"] = np.frombuffer(row["vectors"], np.float64).reshape(n, dims)
    return out


def _search(dims: int, centre: np.ndarray, rotate: np.ndarray, k: int, errors: float):
    def search(queries: pa.Table, codes: pa.Table) -> pa.Table:
        q = matrix(queries.column("v"), dims)
        q_rids = queries.column("rid").to_numpy()
        best: list[Best] = []
        for i in range(len(codes)):
            row = {n: codes.column(n)[i].as_py() for n in codes.column_names}
            scan(q, q_rids, opened(row, dims), centre, rotate, k, errors, best)
        found = joined(best, k)
        return pa.table([pa.array(q_rids[found.query]), pa.array(found.id), pa.array(found.score)],
                        names=["rid", "vec_id", "score"])
    return search


def query_blocks(queries: int, size: int, code_blocks: int) -> int:
    """How many blocks of the queries: every code block is copied to each of them, so where there
    are many tiles they are up to 8 times as large."""
    return min(blocks_of(queries, size), max(blocks_of(queries, 8 * size),
                                             blocks_of(TILES, code_blocks)))


def _sums(dims: int):
    """Partial sums of the components, one row a task."""
    def sums(batches):
        total = np.zeros(dims)
        for b in batches:
            total += matrix(pa.Table.from_batches([b]).column("v"), dims).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"total": pa.array([total.tolist()],
                                                            pa.list_(pa.float64()))})
    return sums


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 20, vec_id: str = "vec_id",
            vec: str = "embedding", bits: int | None = None, errors: float = 3.0, seed: int = 7,
            query_block: int = 512, block_bytes: int = 16_000_000) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of largest inner product found.

    ``bits`` of a code are by default 256, or the dimensions in steps of 64 if these are more.
    ``is_query`` is read on the input's columns.
    """
    x = F.col(vec).cast("array<double>")
    v = numbered(vectors.where(F.exists(x, lambda e: e != 0)), vec_id, vec, "vectors-to-code",
                 is_query=F.coalesce(is_query, F.lit(False)))
    n = v.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q"),
              F.coalesce(F.max(F.size("v")), F.lit(1)).alias("dims")).first()
    bits = bits or max(256, -(-n.dims // 64) * 64)
    parts = v.select("v").mapInArrow(_sums(n.dims), "total array<double>").collect()
    centre = np.sum([r.total for r in parts] or [np.zeros(n.dims)], axis=0) / max(1, n.n)
    rotate = rotation(n.dims, bits, seed)
    cbs = blocks_of(n.n, max(256, block_bytes // (8 * n.dims)))
    qbs = query_blocks(n.q, query_block, cbs)
    codes = v.withColumn("cb", deal(cbs, 1)).groupBy("cb").applyInArrow(
        _encode(n.dims, centre, rotate), CODES)
    queries = v.where("is_query").select("rid", "vec_id", "v")
    found = tiles(queries.withColumn("qb", deal(qbs, 2)).withColumn("cb", every(cbs)),
                  codes.withColumn("qb", every(qbs)),
                  _search(n.dims, centre, rotate, k, errors), FOUND)
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return found.join(queries.select("rid", F.col("vec_id").alias("query_id")), "rid").select(
        "query_id", "rank", "vec_id", "score")
