"""Near-duplicate documents by order MinHash, verified by banded alignment.

1. Exact copies are one text from here on: texts are grouped by a 128-bit hash, and only one
   representative of each goes on (a group's size never matters again).
2. A text's words form shingles of ``k`` words, each labelled with its occurrence number. Each of
   ``bands * rows`` sketches takes the ``tuple_size`` labelled shingles with the lowest hashes and
   keeps them in text order, so that a sketch agrees for texts that share the shingles in the
   same order. ``rows`` sketches make a band key.
3. Texts with a band key in common are candidates. Within a bucket, texts link to the bucket's
   centre only (its most connected text, see ``_buckets``), so a bucket of n texts gives n - 1
   candidates. Texts of buckets that still hold several classes are sketched again, with
   ``fine_bands`` longer keys of ``fine_rows`` sketches, which keep texts just below the threshold
   apart; in these buckets the members outside their centre's class get a new centre, round
   after round until a round finds no link. The texts of fine buckets that then still hold several
   classes are compared by their rarest shingles: texts that reach the threshold share one of
   their first 1 - ``threshold`` (or less) shingles in the order of frequency, and those of
   different classes that do are candidates. None is lost by that, and texts that differ from the
   group by shingles of their own have no partner there, so that a bucket of n texts gives far
   fewer than n * n. With two shingles a sketch, a pair at 0.8 shares a band with a chance of
   0.99997, and a fine band with 0.99.
4. Each candidate is verified by alignment of its shingle sequences inside the band that a
   similarity of ``threshold`` allows: with c shingles aligned, the similarity is
   c / (n_a + n_b - c). Links join into classes; the class id is the least document id.

Edge cases: a null text is a class of its own for each row; texts without words are near
duplicates of exact copies only; a text of fewer than ``k`` words is one shingle; repeated
documents are exact copies; an empty table gives no rows; null ids get the class of their text.
Very long texts are used in whole. Other input columns may have any names; they are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.llm.common import (
    hash64,
    materialise,
    shingle_hashes,
    word_hashes,
    worker_free,
)


def text_key(text: str = "text") -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def labelled_shingles(text: str | None, k: int) -> np.ndarray:
    """Hashes of the text's shingles in order, each mixed with its occurrence number."""
    h = word_hashes(text)
    if not len(h):
        return h
    s = shingle_hashes(h, min(k, len(h)))
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    if len(start) == len(s):
        return s
    nth = np.empty(len(s), np.uint64)
    sizes = np.diff(np.append(start, len(s)))
    nth[order] = (np.arange(len(s)) - np.repeat(start, sizes)).astype(np.uint64)
    return np.where(nth > 0, hash64(s + hash64(nth, 1), 2), s)


def order_sketches(s: np.ndarray, n: int, size: int) -> np.ndarray:
    """``n`` sketches: the ``size`` lowest labelled shingles of a hash each, in text order."""
    rng = np.random.default_rng(20)
    flip = rng.integers(0, 2**64, n, np.uint64)[:, None]
    odd = rng.integers(0, 2**64, n, np.uint64)[:, None] | np.uint64(1)
    size = min(size, len(s))
    out = np.empty(n, np.uint64)
    step = max(1, (1 << 18) // len(s))  # 2 MB of hashes at once
    for lo in range(0, n, step):
        with np.errstate(over="ignore"):
            h = (s[None, :] ^ flip[lo:lo + step]) * odd[lo:lo + step]
            row = np.arange(len(h))
            at = np.empty((len(h), size), np.int64)
            for r in range(size):
                at[:, r] = h.argmin(axis=1)
                h[row, at[:, r]] = np.uint64(0xFFFFFFFFFFFFFFFF)
            at.sort(axis=1)
            key = np.zeros(len(h), np.uint64)
            for r in range(size):
                key = hash64(key + s[at[:, r]], 9)
        out[lo:lo + step] = key
    return out


def alignment_similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """c / (n_a + n_b - c) for the c shingles of the best alignment in the band; 0 if that
    cannot reach the threshold. The band holds every alignment that reaches it."""
    na, nb = len(a), len(b)
    if not na or not nb or min(na, nb) < threshold * max(na, nb) - 1e-9:
        return 0.0
    need = int(np.ceil(threshold * (na + nb) / (1 + threshold) - 1e-9))
    ca, cb = Counter(a.tolist()), Counter(b.tolist())
    if sum((ca & cb).values()) < need:
        return 0.0
    same = a[:min(na, nb)] == b[:min(na, nb)]
    head = len(same) if same.all() else int(same.argmin())
    a, b = a[head:], b[head:]
    m = min(len(a), len(b))
    same = a[::-1][:m] == b[::-1][:m]
    tail = m if same.all() else int(same.argmin())
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    # a match of a[i] and b[j] needs -left <= i - j <= right to reach `need` in all
    left, right = nb - need, na - need
    band = (1 << (left + right + 1)) - 1
    every = (1 << len(a)) - 1
    row = every  # bit i is 0 where the longest common subsequence grows at a[i]
    for j, x in enumerate(b.tolist()):
        hit = at.get(x, 0)
        if hit:
            hit &= band << (j - left) if j >= left else band >> (left - j)
            kept = row & hit
            row = ((row + kept) | (row - kept)) & every
    c = head + tail + len(a) - row.bit_count()
    sim = c / (na + nb - c)
    return sim if sim >= threshold - 1e-12 else 0.0


def _sketch(texts: DataFrame, k: int, bands: int, rows: int, size: int) -> DataFrame:
    """(band key, text id) of every text that has words."""
    def run(batches):
        worker_free("ByteBPE")
        for b in batches:
            ids, keys = [], []
            for t, own in zip(b.column(1).to_pylist(), b.column(0).to_pylist(), strict=True):
                s = labelled_shingles(t, k)
                if len(s):
                    sk = order_sketches(s, bands * rows, size).reshape(bands, rows)
                    with np.errstate(over="ignore"):
                        key = np.arange(bands, dtype=np.uint64)
                        for r in range(rows):
                            key = hash64(key + sk[:, r], 3 + r)
                    ids += [own] * bands
                    keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)),
                 pa.array(ids, pa.binary())], names=["bucket", "tid"])

    return texts.mapInArrow(run, "bucket long, tid binary")


def _verified(edges: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """The edges (a, b, root, c_root) whose texts are similar."""
    t = lambda side: texts.select(F.col("tid").alias(side), F.col("text").alias(f"text_{side}"))
    pairs = edges.join(t("a"), "a").join(t("b"), "b")

    def run(batches):
        for b in batches:
            at = {c: b.column(b.schema.get_field_index(c)) for c in b.schema.names}
            keep, last = [], (None, None)
            for i, (x, y) in enumerate(zip(at["text_a"].to_pylist(), at["text_b"].to_pylist(),
                                           strict=True)):
                if last[0] != y:  # a centre's edges come in runs
                    last = (y, labelled_shingles(y, k))
                if alignment_similarity(labelled_shingles(x, k), last[1], threshold):
                    keep.append(i)
            rows, names = pa.array(keep, pa.int64()), ("a", "b", "root", "c_root")
            yield pa.RecordBatch.from_arrays([at[c].take(rows) for c in names], names=names)

    return pairs.mapInArrow(run, "a binary, b binary, root binary, c_root binary")


def propagate(stars: DataFrame, name: str = "stars") -> DataFrame:
    """``stars`` (member, centre, label) with each member's label the least of its component.

    Every centre is a member of itself. A centre takes the least label of its members, and a
    member the least of its centres, until no label changes. From the second step on a label, which
    is a text of the component, is replaced by that text's own label, so that labels reach twice
    as far each time and long chains take logarithmic steps. A node is a member of few centres
    (one for a band), so only centres and labels are hot: their minima combine map-side, and they
    are written, so that the joins deal both sides anew and can split a centre of many members.
    """
    first = True
    while True:
        least = materialise(stars.groupBy(F.col("centre").alias("c")).agg(
            F.min("label").alias("low")), f"{name}-least")
        of_member = Window.partitionBy("member")
        moved = stars.join(least, F.col("centre") == F.col("c")).select(
            "member", "centre", F.min("low").over(of_member).alias("low"), "label")
        if not first:
            moved = materialise(moved, f"{name}-low")
            jump = materialise(moved.groupBy(F.col("member").alias("j")).agg(
                F.min("low").alias("far")), f"{name}-jump")
            moved = moved.join(jump, F.col("low") == F.col("j"), "left").withColumn(
                "low", F.least("low", F.coalesce("far", "low")))
        first = False
        moved = materialise(moved.select("member", "centre", F.col("low").alias("label"),
                                         (F.col("low") != F.col("label")).alias("moved")), name)
        stars = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return stars


def _rare_shingles(texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """(tid, root, n, s, f, place): the texts' labelled shingles in the order of their frequency
    among these texts, as far as a text of ``threshold`` must share one; ``n`` of them in all."""
    def run(batches):
        for b in batches:
            for i, t in enumerate(b.column(2).to_pylist()):
                x = labelled_shingles(t, k)
                at = pa.array(np.full(len(x), i), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at),
                     pa.array(np.full(len(x), len(x), np.int64)), pa.array(x.view(np.int64))],
                    names=["tid", "root", "n", "s"])

    every = materialise(texts.select("tid", "root", "text").mapInArrow(
        run, "tid binary, root binary, n long, s long"), "shingles")
    often = materialise(every.groupBy(F.col("s").alias("f_s")).agg(F.count("*").alias("f"))
                        .where("f > 1"), "shingle-counts")
    counted = every.join(often, F.col("s") == F.col("f_s"), "left").select(
        "tid", "root", "n", "s", F.coalesce("f", F.lit(1)).alias("f"))
    place = F.row_number().over(Window.partitionBy("tid").orderBy("f", "s"))
    return materialise(counted.withColumn("place", place).where(
        (F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
        & (F.col("f") > 1)), "rare-shingles")


def _rare_pairs(texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """(a, b, root, c_root) of all texts of different roots that share enough to be similar.

    ``texts``: tid, root, text. Of two texts the one of more shingles shares one of its first
    1 - threshold with the first 1 - 2 threshold / (1 + threshold) of the other (prefix filter).
    """
    y = _rare_shingles(texts, k, threshold)
    # shingles of several roots only; most of a shingle's texts may have one root, and a pair of
    # different roots has one text outside it
    each = y.groupBy("s", "root").agg(F.count("*").alias("m"))
    several = each.groupBy(F.col("s").alias("g_s")).agg(
        F.max(F.struct("m", "root"))["root"].alias("most"), F.count("*").alias("roots")).where("roots > 1")
    several = materialise(several.select("g_s", "most"), "rare-groups")
    y = materialise(y.join(several, F.col("s") == F.col("g_s")).select(
        "tid", "root", "n", "s", "place", (F.col("root") == F.col("most")).alias("common")),
        "rare-of-several")
    both = 2 * threshold / (1 + threshold)
    x = y.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * both - 1e-9) + 1).select(
        F.col("s").alias("x_s"), F.col("tid").alias("a"), F.col("root").alias("x_root"),
        F.col("n").alias("x_n"), F.col("place").alias("x_place"), F.col("common").alias("x_common"))
    larger = (F.col("n") > F.col("x_n")) | ((F.col("n") == F.col("x_n")) & (F.col("tid") > F.col("a")))
    # the shingles from the shared one on must be enough on both sides (its places are by rarity)
    need = F.ceil((F.col("n") + F.col("x_n")) * (threshold / (1 + threshold)) - 1e-9)
    enough = F.least(F.col("n") - F.col("place"), F.col("x_n") - F.col("x_place")) + 1 >= need
    near = (F.col("x_s") == F.col("s")) & (F.col("x_root") != F.col("root")) & larger & enough \
        & (F.col("x_n") >= F.col("n") * threshold - 1e-9)
    found = x.where("not x_common").join(y, near).union(
        x.where("x_common").join(y.where("not common"), near))
    return found.select("a", F.col("tid").alias("b"), F.col("x_root").alias("root"),
                        F.col("root").alias("c_root")).distinct()


def _buckets(texts: DataFrame, k: int, bands: int, rows: int, size: int) -> DataFrame:
    """(bucket, tid, weight) of the buckets that hold several texts. The weight sums the sizes
    of a text's buckets: the text that a group's others were made from is in the largest."""
    every = materialise(_sketch(texts, k, bands, rows, size), "buckets")
    # written, so that the join can split a bucket of very many texts
    shared = materialise(every.groupBy("bucket").agg(
        F.min("tid").alias("lo"), F.max("tid").alias("hi"), F.count("*").alias("n"))
        .where("lo != hi").select(F.col("bucket").alias("s_bucket"), "n"), "shared")
    kept = materialise(every.join(shared, F.col("bucket") == F.col("s_bucket"))
                       .select("bucket", "tid", "n").distinct(), "kept")
    weight = kept.groupBy(F.col("tid").alias("w_tid")).agg(F.sum("n").alias("weight"))
    return materialise(kept.join(weight, F.col("tid") == F.col("w_tid")).select(
        "bucket", "tid", "weight"), "weighted")


def _open(members: DataFrame) -> DataFrame:
    """The rows of ``members`` in buckets that hold several classes."""
    several = members.groupBy(F.col("bucket").alias("o_bucket")).agg(
        F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    several = materialise(several.select("o_bucket"), "open")
    return materialise(members.join(several, F.col("bucket") == F.col("o_bucket"), "left_semi"),
                       "members")


def _text_classes(some: DataFrame, k: int, threshold: float, bands: int, rows: int,
                  tuple_size: int, fine_bands: int, fine_rows: int) -> DataFrame:
    """By text (tid) of ``some`` (doc_id, tid, text): root (the class's least text), least (the
    text's least id), n (its documents) and n_links (its verified links to other texts)."""
    buckets = _buckets(some.select("tid", "text"), k, bands, rows, tuple_size)
    wanted = buckets.select(F.col("tid").alias("w")).distinct()
    texts = some.groupBy("tid").agg(F.first("text").alias("text"))  # copies meet map-side
    texts = materialise(texts.join(wanted, F.col("tid") == F.col("w"), "left_semi"), "texts")
    members = buckets.withColumn("root", F.col("tid"))
    stars = links = classes = tested = every_fine = None

    def grown(edges):
        """Verify the edges and let the classes grow by their links; whether there are none."""
        nonlocal stars, links, classes, tested
        tested = edges.select("a", "b") if tested is None else tested.union(edges.select("a", "b"))
        found = materialise(_verified(edges, texts, k, threshold), "links")
        links = found if links is None else links.union(found)
        none = found.isEmpty()
        if classes is None or not none:
            new = found.select(F.explode(F.array(
                F.struct(F.col("a").alias("member"), F.col("b").alias("centre"),
                         F.col("root").alias("label")),
                F.struct(F.col("b").alias("member"), F.col("b").alias("centre"),
                         F.col("c_root").alias("label")))).alias("s")).select("s.*").distinct()
            stars = propagate(new if stars is None else stars.union(new))
            classes = materialise(stars.groupBy(F.col("member").alias("node")).agg(
                F.min("label").alias("label")), "classes")
        return none

    def named(m):
        return m.drop("root").join(classes, F.col("tid") == F.col("node"), "left").select(
            "bucket", "tid", "weight", F.coalesce("label", "tid").alias("root"))

    while True:
        best = F.struct("weight", F.xxhash64("tid", "bucket"), "tid", "root")
        centres = materialise(members.groupBy("bucket").agg(F.max(best).alias("d")).select(
            F.col("bucket").alias("c_bucket"), F.col("d.tid").alias("centre"),
            F.col("d.root").alias("c_root")), "centres")
        edges = materialise(members.join(centres, F.col("bucket") == F.col("c_bucket"))
                            .where("root != c_root").select(
            F.col("tid").alias("a"), F.col("centre").alias("b"), "root", "c_root").distinct(),
            "edges")
        if grown(edges) and every_fine is not None:
            break
        if every_fine is not None:
            # next, the members outside the class of the bucket's centre
            done = centres.join(classes, F.col("centre") == F.col("node"), "left").select(
                F.col("c_bucket").alias("d_bucket"), F.coalesce("label", "centre").alias("d_root"))
            members = _open(materialise(named(members).join(
                done, (F.col("bucket") == F.col("d_bucket")) & (F.col("root") == F.col("d_root")),
                "left_anti"), "outside"))
        else:
            left = _open(materialise(named(members), "named"))
            texts = materialise(texts.join(left.select(F.col("tid").alias("w")).distinct(),
                                           F.col("tid") == F.col("w"), "left_semi"), "texts-left")
            members = every_fine = _open(materialise(named(_buckets(
                texts.select("tid", "text"), k, fine_bands, fine_rows, tuple_size)), "fine"))
        if members.isEmpty():
            break
    # what no star tested, of the texts whose fine buckets still hold several classes
    x = _open(materialise(named(every_fine), "fine-named")).select(
        F.col("tid").alias("x_tid"), "root").distinct()
    pairs = _rare_pairs(texts.join(x, F.col("tid") == F.col("x_tid")), k, threshold)
    both = tested.union(tested.select("b", "a")).select(F.col("a").alias("t_a"),
                                                        F.col("b").alias("t_b"))
    pairs = materialise(pairs.join(both, (F.col("a") == F.col("t_a")) & (F.col("b") == F.col("t_b")),
                                   "left_anti"), "pairs")
    if not pairs.isEmpty():
        grown(pairs)
    classes = classes.withColumnRenamed("label", "root")
    links = links.select("a", "b").distinct()
    degree = links.select(F.explode(F.array("a", "b")).alias("t")).groupBy("t").agg(
        F.count("*").alias("n_links"))
    per_text = some.groupBy("tid").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    per_text = materialise(per_text.join(classes, F.col("tid") == F.col("node"), "left").join(
        degree, F.col("tid") == F.col("t"), "left").select(
        "tid", F.coalesce("root", "tid").alias("root"), "least", "n",
        F.coalesce("n_links", F.lit(0)).alias("n_links")), "per-text")
    return per_text


def _texts_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.where(F.col(text).isNotNull()).select(
        F.col(doc_id).alias("doc_id"), text_key(text).alias("tid"), F.col(text).alias("text"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 5,
                    threshold: float = 0.8, bands: int = 20, rows: int = 2,
                    tuple_size: int = 2, fine_bands: int = 160, fine_rows: int = 8) -> DataFrame:
    """One row per document: doc_id, class_id (least id of its class), class_size (the class's
    documents) and n_links (verified links of the document's text to other texts)."""
    some = _texts_of(docs, doc_id, text)
    per_text = _text_classes(some, k, threshold, bands, rows, tuple_size, fine_bands, fine_rows)
    # written: the joins can then split a class or text of many rows
    per_class = materialise(per_text.groupBy("root").agg(
        F.min("least").alias("class_id"), F.sum("n").alias("class_size")), "per-class") \
        .withColumnRenamed("root", "c_root")
    of_text = per_text.join(per_class, F.col("root") == F.col("c_root")).select(
        F.col("tid").alias("o_tid"), "class_id", "class_size", "n_links")
    out = some.select("doc_id", "tid").join(of_text, F.col("tid") == F.col("o_tid")).select(
        "doc_id", "class_id", "class_size", "n_links")
    own = F.col(doc_id)
    alone = docs.where(F.col(text).isNull()).select(
        own.alias("doc_id"), own.alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(0).cast("long").alias("n_links"))
    return out.union(alone)


def deduplicate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 5,
                threshold: float = 0.8, bands: int = 20, rows: int = 2,
                tuple_size: int = 2, fine_bands: int = 160, fine_rows: int = 8) -> DataFrame:
    """``docs`` with one document of each class: that of the least id (a null id only where no
    other is there). Documents without a text stay."""
    some = _texts_of(docs, doc_id, text)
    per_text = _text_classes(some, k, threshold, bands, rows, tuple_size, fine_bands, fine_rows)
    first = F.struct(F.col("least").isNull().alias("no_id"), "least", "tid")
    winners = per_text.groupBy("root").agg(F.min(first).alias("w")).select(
        F.col("w.least").alias("w_id"), F.col("w.tid").alias("w_tid"))
    # the rows as one column, so that no name of theirs meets one of ours
    row = docs.where(F.col(text).isNotNull()).select(
        F.struct("*").alias("row"), text_key(text).alias("tid"), F.col(doc_id).alias("id"))
    kept = row.join(winners, (F.col("tid") == F.col("w_tid"))
                    & F.col("id").eqNullSafe(F.col("w_id")), "left_semi")
    one = kept.dropDuplicates(["tid", "id"]).select("row.*")  # rows that repeat id and text
    return one.union(docs.where(F.col(text).isNull()))
