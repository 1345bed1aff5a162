"""Prefix trie of conversations, with totals of all subtrees by centroid decomposition.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns,
known by its depth and a 128-bit hash of the turns (sums of position-wise hashes, so a running
sum gives the hashes of all prefixes, in chunks of a long conversation too). Grouping
the conversations by prefix gives each node's members, smallest member and weight: the turns
that its members have from it on, which is the subtree's sum of members.

Subtree totals (leaves, saved tokens) are rolled up over the forest of parent edges. A component
is a connected part of it; its top is the node nearest to the root. In each round,

* the component's weight is its top's, the nodes of at least half of it form the path from the
  top down, and the last of them is the centroid;
* the centroid's part below is added up, and that total goes to all nodes of the centroid-to-top
  path, the centroid's own being whole by that;
* the centroid goes, each subtree below it is a component of its own, and the rest above it
  loses the part's weight.

No component has more than half of its predecessor's weight, so the rounds are logarithmic in
the turns however deep the trie is. Components above ``local_weight`` are split by joins: a node's
side of the centroid is looked up in the prefixes of its smallest member. Smaller ones are split to
the end inside tasks, many at a time, in vector steps over at most about ``local_weight`` nodes.

Edge cases: rows with a null conversation id are left out; null turns come first; equal turn
numbers are ordered by role, then by the text's MD5; null roles and texts count as empty; rows
that are repeated are turns of their own; empty sequences are members of the root only; very
long conversations are ordered and hashed in chunks; an empty table gives no nodes. Other input
columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.llm.common import materialise

CHUNK = 4096  # turns of one conversation that are summed in one group
KEY = ["ka", "kb"]
TOTALS = "ka long, kb long, leaves long, saved long"
END_BLOCK = "ka long, kb long, first long, ids binary"
END_HASH = "ka long, kb long, ends_sha256 string"


# --- turns -----------------------------------------------------------------------

def ordered_turns(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """c, pos (from 1), role, digest (of the text), size (its UTF-8 bytes) and chunk.

    The order of a conversation is counted in chunks of a global sort, so that no conversation
    is one group.
    """
    text = F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.md5(text).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("rid"))
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"), F.asc("rid")]
    rows = materialise(rows.repartitionByRange(F.asc("c"), *order).withColumn(
        "chunk", F.spark_partition_id()), "turns")
    before = F.sum("n").over(Window.partitionBy("c").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1))
    chunks = rows.groupBy("c", "chunk").agg(F.count("*").alias("n")).select(
        "c", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("c", "chunk").orderBy(*order))
    return rows.join(chunks, ["c", "chunk"]).select(
        "c", (place + F.col("before")).alias("pos"), "role", "digest", "size")


def branched(turns: DataFrame, *, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as branches: the first ``head`` turns (at most ``most``) of
    conversation ``base``, then the own turns after the first ``head``.

    ``base`` and ``head`` are over column ``c``. Returns the rebuilt turns and (c, length).
    """
    turns = materialise(turns, "ordered-turns")
    own = turns.groupBy("c").agg(F.count("*").alias("n"))
    convs = own.select("c", "n", base.alias("base"), head.alias("head"))
    sizes = own.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(sizes, "base", "left").select(
        "c", "base", "head", "n",
        F.least("head", F.coalesce("base_n", F.lit(0))).alias("copied"))
    length = F.when(F.col("base") == F.col("c"), F.col("n")).otherwise(
        F.col("copied") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    convs = materialise(convs.withColumn("length", length), "branches")
    item = ["role", "digest", "size"]
    # without the branches' table: a row's head is of its id, only the shift is looked up
    kept = turns.withColumn("base", base).withColumn("head", head)
    whole = kept.where(F.col("base") == F.col("c")).select("c", "pos", *item)
    rest = kept.where((F.col("base") != F.col("c")) & (F.col("pos") > F.col("head")))
    rest = rest.join(convs.select("c", "copied"), "c").select(
        "c", (F.col("pos") - F.col("head") + F.col("copied")).alias("pos"), *item)
    heads = turns.where(F.col("pos") <= most).withColumnRenamed("c", "base").join(
        convs.where(F.col("base") != F.col("c")).select("c", "base", "head"), "base")
    heads = heads.where(F.col("pos") <= F.col("head")).select("c", "pos", *item)
    return whole.union(rest).union(heads), convs.select("c", "length")


# --- prefixes and nodes --------------------------------------------------------------

def _key(seed: int, depth: Column, sums: list[Column]) -> Column:
    return F.xxhash64(F.lit(seed), depth.cast("long"), *sums)


def prefixes(turns: DataFrame, sequences: DataFrame) -> DataFrame:
    """c, d, key of the prefix of d turns, key of its parent, size of its last text, length.

    One row for each conversation and depth, the empty prefix included.
    """
    rows = turns.join(sequences, "c").withColumn("part", F.floor((F.col("pos") - 1) / CHUNK))
    names = ["s0", "s1", "s2", "s3"]
    halves = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), F.col("pos").cast("long"), F.col("role"), F.col("digest"))
        halves += [h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)]
    rows = rows.select("c", F.col("pos").cast("long").alias("d"), "part", "size", "length",
                       *[h.alias(n) for h, n in zip(halves, names, strict=True)])
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    long_ones = rows.where(F.col("length") > CHUNK)
    carry = long_ones.groupBy("c", "part").agg(*[F.sum(n).alias(n) for n in names]).select(
        "c", "part", *[F.sum(n).over(before).alias("c" + n) for n in names])
    running = Window.partitionBy("c", "part").orderBy("d").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", *[F.sum(n).over(running).alias("r" + n) for n in names])
    rows = rows.join(carry, ["c", "part"], "left")
    sums = [F.col("r" + n) + F.coalesce("c" + n, F.lit(0)) for n in names]
    up = [s - F.col(n) for s, n in zip(sums, names, strict=True)]
    d = F.col("d")
    rows = rows.select("c", "d", _key(3, d, sums).alias("ka"), _key(4, d, sums).alias("kb"),
                       _key(3, d - 1, up).alias("pa"), _key(4, d - 1, up).alias("pb"),
                       "size", "length")
    zero, none = [F.lit(0).cast("long")] * 4, F.lit(None).cast("long")
    roots = sequences.select("c", F.lit(0).cast("long").alias("d"),
                             _key(3, F.lit(0), zero).alias("ka"),
                             _key(4, F.lit(0), zero).alias("kb"), none.alias("pa"),
                             none.alias("pb"), F.lit(0).cast("long").alias("size"), "length")
    return rows.union(roots)


def trie_nodes(paths: DataFrame) -> DataFrame:
    """One row for each distinct prefix, with its parent's smallest member and its children."""
    own = paths.groupBy("ka", "kb", "d").agg(
        F.min("c").alias("conv_id"), F.count("*").alias("n_convs"),
        F.sum(F.col("length") - F.col("d") + 1).alias("weight"), F.max("size").alias("size"),
        F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    own = materialise(own, "trie-prefixes")
    up = own.select(F.col("ka").alias("pa"), F.col("kb").alias("pb"),
                    F.col("conv_id").alias("parent_conv_id"))
    kids = own.where(F.col("pa").isNotNull()).groupBy(
        F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count("*").alias("n_children"))
    # the join with many children of one parent has its own stage, so that it can be split
    nodes = materialise(own.join(up, ["pa", "pb"], "left"), "trie-parents")
    return nodes.join(kids, KEY, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)))


# --- totals of subtrees ------------------------------------------------------------------

def _split_local(top: np.ndarray, parent: np.ndarray, depth: np.ndarray, weight: np.ndarray,
                 values: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Totals of all nodes of some whole components, decomposed in vector steps.

    ``top``: each node's component, by its top's place; ``parent``: the parent's place, -1 at a
    top; ``weight``: of the subtree inside the component; ``total``: what larger components' splits
    have added so far.
    """
    n = len(top)
    child = np.flatnonzero(parent >= 0)
    own = weight.copy()  # of the node alone
    np.subtract.at(own, parent[child], weight[child])
    # places in depth-first order, as running weights: a subtree is an interval
    by_parent = child[np.argsort(parent[child], kind="stable")]
    w, p = weight[by_parent], parent[by_parent]
    run = np.cumsum(w) - w
    first = np.searchsorted(p, p)
    place = np.zeros(n, np.int64)
    place[by_parent] = run - run[first] + own[p]
    tops = np.flatnonzero(parent < 0)
    place[tops] = np.cumsum(weight[tops]) - weight[tops]
    up = parent.copy()
    while (up >= 0).any():  # pointer jumping: places of all ancestors are added
        at = np.flatnonzero(up >= 0)
        place[at], up[at] = place[at] + place[up[at]], up[up[at]]
    end = place + weight
    base = int(end.max(initial=0)) + 1
    order = np.lexsort((place[child], parent[child]))
    kids = child[order]
    kid_keys = parent[kids] * base + place[kids]
    weight, total, alive = weight.copy(), total.copy(), np.ones(n, bool)
    while alive.any():
        at = np.flatnonzero(alive)
        t = top[at]
        on_path = at[2 * weight[at] >= weight[t]]
        deepest = np.full(n, -1)
        np.maximum.at(deepest, top[on_path], depth[on_path])
        is_g = depth[on_path] == deepest[top[on_path]]
        centroid = np.full(n, -1)
        centroid[top[on_path[is_g]]] = on_path[is_g]
        g = centroid[t]
        below = (place[at] >= place[g]) & (place[at] < end[g])
        added = np.zeros((n, values.shape[1]), np.int64)
        np.add.at(added, t[below], values[at[below]])
        total[on_path] += added[top[on_path]]
        above = on_path[~is_g]
        weight[above] -= weight[centroid[top[above]]]
        alive[on_path[is_g]] = False
        moved = below & (at != g)
        found = np.searchsorted(kid_keys, g[moved] * base + place[at[moved]], "right") - 1
        top[at[moved]] = kids[found]
    return total


def _local_totals(rows: int):
    """mapInArrow function over rows sorted by component: totals of their nodes."""
    def solve(t: pa.Table) -> pa.RecordBatch:
        col = lambda c: t.column(c).to_numpy()
        keys = pd.MultiIndex.from_arrays([col("ka"), col("kb")])
        at = lambda a, b: keys.get_indexer(pd.MultiIndex.from_arrays([col(a), col(b)]))
        top = at("ta", "tb")
        parent = at("pa", "pb")
        parent[(top == np.arange(len(top))) | (parent < 0)] = -1
        total = _split_local(top.copy(), parent, col("d"), col("weight"),
                             np.stack([col("leaf"), col("saving")], 1),
                             np.stack([col("leaves"), col("saved")], 1))
        return pa.RecordBatch.from_pydict({
            "ka": col("ka"), "kb": col("kb"), "leaves": total[:, 0], "saved": total[:, 1]})

    def run(batches):
        held: list[pa.Table] = []
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            if sum(t.num_rows for t in held) >= rows:
                t = pa.concat_tables(held)
                a, b_ = t.column("ta").to_numpy(), t.column("tb").to_numpy()
                edge = np.flatnonzero((a[1:] != a[:-1]) | (b_[1:] != b_[:-1]))
                if len(edge):  # whole components only; the last may go on
                    cut = int(edge[-1]) + 1
                    yield solve(t.slice(0, cut))
                    t = t.slice(cut)
                held = [t]
        if held:
            t = pa.concat_tables(held)
            if t.num_rows:
                yield solve(t)
    return run


def centroid_totals(nodes: DataFrame, paths: DataFrame, *, local_weight: int = 1 << 15) -> DataFrame:
    """ka, kb, leaves, saved: sums of ``leaf`` and ``saving`` over each node's subtree.

    ``nodes``: ka, kb, pa, pb, d, conv_id, weight (of the subtree), leaf, saving; ``paths``: each
    conversation's prefixes (c, d, ka, kb, pa, pb).
    """
    zero = F.lit(0).cast("long")
    root = nodes.where(F.col("d") == 0).select(F.col("ka").alias("ta"), F.col("kb").alias("tb"),
                                               F.col("weight").alias("whole"))
    tops = root.take(1)
    if not tops:
        return nodes.select(*KEY, F.col("leaf").alias("leaves"), F.col("saving").alias("saved"))
    # not a constant to the optimiser: joins on it stay joins by key
    (a, b, whole), long = tops[0], lambda x: F.when(F.col("d") >= 0, F.lit(x).cast("long"))
    up = [F.coalesce(k, zero).alias(k) for k in ("pa", "pb")]
    now = nodes.select(*KEY, *up, "d", "conv_id", "weight", "leaf", "saving",
                       zero.alias("leaves"), zero.alias("saved"), long(a).alias("ta"),
                       long(b).alias("tb"), long(whole).alias("whole"))
    side = paths.select(F.col("c").alias("conv_id"), F.col("d").alias("at"),
                        F.col("ka").alias("na"), F.col("kb").alias("nb"),
                        F.col("pa").alias("npa"), F.col("pb").alias("npb"))
    columns, small, done = now.columns, [], []
    while True:
        small.append(now.where(F.col("whole") <= local_weight))
        large = now.where(F.col("whole") > local_weight)
        if large.isEmpty():
            break
        on_path = 2 * F.col("weight") >= F.col("whole")
        g = large.where(on_path).groupBy("ta", "tb").agg(
            F.max(F.struct("d", *KEY, "weight")).alias("g"))
        x = large.join(g, ["ta", "tb"]).withColumn(
            "at", F.when(F.col("d") > F.col("g.d"), F.col("g.d") + 1))
        x = x.join(side, ["conv_id", "at"], "left")
        is_g = (F.col("ka") == F.col("g.ka")) & (F.col("kb") == F.col("g.kb"))
        below = (F.col("npa") == F.col("g.ka")) & (F.col("npb") == F.col("g.kb"))
        x = materialise(x.select(
            *columns, "na", "nb", F.col("g.weight").alias("part"), is_g.alias("is_g"),
            F.coalesce(below, F.lit(False)).alias("below"), on_path.alias("on_path")), "centroids")
        added = x.where("is_g or below").groupBy("ta", "tb").agg(
            F.sum("leaf").alias("more_leaves"), F.sum("saving").alias("more_saved"))
        path = x.where("on_path").join(added, ["ta", "tb"]).withColumn(
            "leaves", F.col("leaves") + F.col("more_leaves")).withColumn(
            "saved", F.col("saved") + F.col("more_saved"))
        path = materialise(path.select(x.columns), "centroid-paths")
        done.append(path.where("is_g").select(*KEY, "leaves", "saved"))
        left = F.col("whole") - F.col("part")
        up = path.where("not is_g").withColumn("weight", F.col("weight") - F.col("part")).union(
            x.where("not on_path and not below")).withColumn("whole", left)
        child = x.where("below and ka = na and kb = nb").select(
            *[F.col(k).alias("n" + k[1]) for k in KEY], F.col("weight").alias("own"))
        down = x.where("below").join(child, ["na", "nb"]).withColumn("ta", F.col("na")).withColumn(
            "tb", F.col("nb")).withColumn("whole", F.col("own"))
        now = materialise(up.select(columns).union(down.select(columns)), "components")
    rows = small[0]
    for s in small[1:]:
        rows = rows.union(s)
    out = rows.repartition("ta", "tb").sortWithinPartitions("ta", "tb", "d").mapInArrow(
        _local_totals(max(20_000, local_weight)), TOTALS)
    for d in done:
        out = out.union(d)
    return out


# --- conversations that end at a node ----------------------------------------------------------

def _runs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal (a, b), and the end."""
    edge = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
    return np.concatenate([[0], edge, [len(a)]])


def _id_blocks(batches):
    """Sorted (ka, kb, c) to one row for a run of one node's ids: the ids, comma-joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, c = (batch.column(n).to_numpy() for n in ("ka", "kb", "c"))
        at = _runs(a, b)
        ids = c.astype(str).tolist()
        starts = at[:-1]
        yield pa.RecordBatch.from_pydict({
            "ka": a[starts], "kb": b[starts], "first": c[starts],
            "ids": pa.array([",".join(ids[lo:hi]).encode() for lo, hi in zip(
                starts, at[1:], strict=True)], pa.binary())})


def _id_hashes(batches):
    """Blocks sorted by node and first id to one hash for a node, block by block."""
    node, state = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(n).to_pylist() for n in ("ka", "kb", "ids")),
                             strict=True):
            if node == (a, b):
                state.update(b",")
            else:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (a, b), hashlib.sha256()
            state.update(ids)
        if out:
            yield _hash_rows(out)
    if node:
        yield _hash_rows([(*node, state.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    a, b, h = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({"ka": pa.array(a, pa.int64()), "kb": pa.array(b, pa.int64()),
                                       "ends_sha256": pa.array(h, pa.string())})


def end_hashes(paths: DataFrame) -> DataFrame:
    """ka, kb, ends_sha256 of the nodes at which conversations end.

    The ids of a node are sorted and joined in parts over all tasks; one task puts the few
    parts of a node through the hash, without holding them.
    """
    ends = paths.where(F.col("d") == F.col("length")).select(*KEY, "c")
    blocks = ends.repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c").mapInArrow(
        _id_blocks, END_BLOCK)
    return blocks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(
        _id_hashes, END_HASH)


def prefix_trie(turns: DataFrame, sequences: DataFrame, *, local_weight: int = 1 << 15) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: c, pos (from 1, without gaps), role, digest, size; ``sequences``: c, length of all
    conversations, those without turns included.
    """
    paths = materialise(prefixes(turns, sequences), "prefixes")
    nodes = trie_nodes(paths)
    saving = F.when(F.col("d") > 0, (F.col("n_convs") - 1) * F.col("size")).otherwise(0)
    nodes = materialise(nodes.select(
        "*", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
        saving.cast("long").alias("saving")), "trie-nodes")
    totals = centroid_totals(nodes, paths, local_weight=local_weight)
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.select(*KEY, "conv_id", "d", "parent_conv_id", "n_convs", "n_children")
            .join(totals, KEY).join(end_hashes(paths), KEY, "left").select(
                "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children",
                F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
