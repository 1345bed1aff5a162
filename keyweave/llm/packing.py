"""Sequence packing: shortest-pack-first over the length histogram.

1. Every document is tokenised once, in whole, and cut into pieces: full sequences of
   ``size`` tokens and one remainder. Only the pieces' sizes and checksums go on.
2. The histogram of piece lengths (at most ``size`` rows, whatever the corpus) is packed:
   lengths are placed longest first, each onto the shortest open pack pattern that it fits
   (the one with the most room), updating the counts of the patterns.
3. Patterns that end with more than ``max_room`` tokens of room are given up: their pieces are
   laid end to end, longest first, and cut where a sequence is full. So padding stays small where
   lengths do not fit each other, as when very many documents have one length; a piece is cut at
   most once, and there is about one cut for each such sequence.
4. Places join back to documents by rank: the m packs of one pattern take the next m ranks of
   each of their lengths. Ranks are taken within (length, salt) groups, with the groups' totals
   added up before them, so a length that a third of all documents share is no single task.
   Only documents with a cut are tokenised again, for the checksums of the two parts.

Edge cases: a null text counts as empty; an empty text is the end id alone; repeated documents
are packed row by row; null ids are kept; very long texts are cut into many pieces; an empty
table gives no pieces; the string of an added token is that token, as the file's tokenizer has it.
Other input columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyweave.llm.common import materialise, worker_object

PIECE_SCHEMA = ("doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, salt int, "
                "text_key long")
PLACED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


#: How a byte-level BPE cuts text before merging, and the characters that stand
#: for the bytes that have no printable character of their own.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE(dict):
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    The tokenizer never merges across the space that starts a word, so a text splits at each
    space that precedes a non-space, and a chunk's ids are kept for its next occurrence (the
    cache is bounded). Chunks go through tiktoken with the same file's vocabulary, which gives
    the same ids in less than half the time. Texts with other white space around spaces, with
    characters beyond the Latin letters, or with the string of an added token (which is that
    token, as in the file; plain text if ``added_as_text``) go through tokenizers in one go.
    """

    LIMIT, LONGEST = 200_000, 32  # about 40 MB

    def __init__(self, path: str, added_as_text: bool = True):
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = added_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = byte_of_character()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(of[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        self.latin = tiktoken.Encoding("file", pat_str=PRETOKEN, mergeable_ranks=ranks,
                                       special_tokens={})
        self.plain = self.latin.encode_ordinary
        self.special = re.compile("|".join([r"[^\x00-\u024f]| (?:\s|$)",
                                            *map(re.escape, sorted(special))])).search

    def __missing__(self, chunk: str) -> bytes:
        out = array("I", self.plain(" " + chunk)).tobytes()
        if len(chunk) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[chunk] = out
        return out

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.special(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = text.split(" ")
        return b"".join([array("I", self.plain(first)).tobytes(),
                         *map(self.__getitem__, rest)])


def pieces(docs: DataFrame, tokenizer_path: str, *, size: int = 2048, end_id: int = 1,
           doc_id: str = "doc_id", text: str = "text", salts: int = 64) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, salt, text_key."""
    end = end_id.to_bytes(4, "little")
    kind = dict(docs.select(F.col(doc_id)).dtypes)[doc_id]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_object(("ByteBPE", tokenizer_path), lambda: ByteBPE(tokenizer_path, False))
        for b in batches:
            at, start, length, crc, total = [], [], [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                ids = bpe.ids(t) + end
                n = len(ids) // 4
                for lo in range(0, n, size):
                    part = ids[4 * lo:4 * (lo + size)]
                    at.append(k)
                    start.append(lo)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
            rows = pa.array(at, pa.int64())
            salt = (b.column(2).to_numpy()[at] + np.array(start, np.int64) // size) % salts
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64()), pa.array(total, pa.int64()),
                 pa.array(salt.astype(np.int32)), b.column(3).take(rows)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt", "text_key"])

    cols = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(salts)).alias("salt"),
                       F.xxhash64(F.col(text)).alias("text_key"))
    return cols.mapInArrow(cut, PIECE_SCHEMA.format(kind))


def halves(docs: DataFrame, cuts: DataFrame, tokenizer_path: str, *, end_id: int, doc_id: str,
           text: str) -> DataFrame:
    """The two parts of each cut piece (``cuts``: placed pieces with ``first``, the tokens of the
    first part, which ends its sequence; the second begins the next)."""
    end = end_id.to_bytes(4, "little")
    texts = docs.select(F.col(doc_id).alias("t_id"), F.xxhash64(F.col(text)).alias("t_key"),
                        F.col(text).alias("text"))
    wanted = cuts.select(F.col("doc_id").alias("w_id"), F.col("text_key").alias("w_key"))
    same = F.col("t_id").eqNullSafe(F.col("w_id")) & (F.col("t_key") == F.col("w_key"))
    texts = texts.join(wanted, same, "left_semi").dropDuplicates(["t_id", "t_key"])
    rows = cuts.join(texts, F.col("doc_id").eqNullSafe(F.col("t_id"))
                     & (F.col("text_key") == F.col("t_key"))).select(
        "doc_id", "text", "start", "length", "doc_tokens", "sequence_id", "offset", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_object(("ByteBPE", tokenizer_path), lambda: ByteBPE(tokenizer_path, False))
        for b in batches:
            at, out = [], []
            for k, (t, start, length, total, sequence, offset, first) in enumerate(
                    zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)):
                ids = bpe.ids(t) + end
                for lo, hi, s, o in ((start, start + first, sequence, offset),
                                     (start + first, start + length, sequence + 1, 0)):
                    at.append(k)
                    out.append((lo, hi - lo, zlib.crc32(ids[4 * lo:4 * hi]), total, s, o))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at, pa.int64())),
                 *(pa.array([r[j] for r in out], pa.int64()) for j in range(6))], names=PLACED)

    kind = dict(cuts.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in PLACED[1:]))


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """Pack patterns (count, lengths longest first) for a histogram of lengths.

    Lengths are placed longest first onto the shortest pack that they fit. Whole groups of
    equal packs are filled at once, so the work depends on the lengths, not on the counts.
    """
    open_by_room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    done: list[tuple[int, list[int]]] = []
    rooms: set[int] = set()
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in rooms if r >= length), default=None)
            if room is None:
                count, pack = left, []
                room = size
            else:
                count, pack = open_by_room[room].pop()
                if count > left:
                    open_by_room[room].append((count - left, pack))
                    count = left
                if not open_by_room[room]:
                    rooms.discard(room)
            left -= count
            if room == length:
                done.append((count, [*pack, length]))
            else:
                open_by_room[room - length].append((count, [*pack, length]))
                rooms.add(room - length)
    return done + [p for r in sorted(open_by_room) for p in open_by_room[r]]


def places(histogram: dict[int, int], size: int, max_room: int) -> list[tuple[int, ...]]:
    """Where the pieces of each length go, by rank: (length, lo, hi, base, offset, step).

    The piece of rank r in [lo, hi) is at ``base * size + offset + (r - lo) * step`` of all
    sequences laid end to end: step ``size`` for a slot of a pattern, its length where pieces
    are laid end to end.
    """
    out, taken, base = [], defaultdict(int), 0
    loose: dict[int, int] = defaultdict(int)
    for count, pattern in shortest_pack_first(histogram, size):
        if size - sum(pattern) > max_room:
            for length in pattern:
                loose[length] += count
            continue
        offset = 0
        for length in pattern:
            out.append((length, taken[length], taken[length] + count, base, offset, size))
            taken[length] += count
            offset += length
        base += count
    at = 0
    for length in sorted(loose, reverse=True):
        n = loose[length]
        out.append((length, taken[length], taken[length] + n, base + at // size, at % size, length))
        at += n * length
    return out


def pack(docs: DataFrame, tokenizer_path: str, *, size: int = 2048, end_id: int = 1,
         doc_id: str = "doc_id", text: str = "text", salts: int = 64,
         max_room: int = 16) -> DataFrame:
    """One row per piece with its place: sequence_id and offset (see the module's text)."""
    spark = docs.sparkSession
    p = materialise(pieces(docs, tokenizer_path, size=size, end_id=end_id, doc_id=doc_id,
                           text=text, salts=salts), "pieces")
    counts = materialise(p.groupBy("length", "salt").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n"))
                 .collect()}  # at most `size` rows
    # bounded by the patterns, of which there are a few for each length
    slots = spark.createDataFrame(places(histogram, size, max_room),
                                  "s_length long, lo long, hi long, base long, shift long, step long")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("length").alias("c_length"), F.col("salt").alias("c_salt"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "text_key")
    ranked = p.withColumn("k", F.row_number().over(within) - 1).join(
        starts, (F.col("length") == F.col("c_length")) & (F.col("salt") == F.col("c_salt")))
    ranked = ranked.withColumn("rank", F.col("first") + F.col("k"))
    at = F.col("shift") + (F.col("rank") - F.col("lo")) * F.col("step")
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("s_length"))
                         & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))) \
        .withColumn("sequence_id", F.col("base") + F.floor(at / size).cast("long")) \
        .withColumn("offset", F.pmod(at, F.lit(size)))
    placed = materialise(placed.select(*PLACED, "text_key"), "placed")
    over = F.col("offset") + F.col("length") > size
    cuts = placed.where(over).withColumn("first", size - F.col("offset"))
    return placed.where(~over).select(*PLACED).union(halves(
        docs, cuts, tokenizer_path, end_id=end_id, doc_id=doc_id, text=text))
