"""Helpers shared by the operators: tables, shared intermediate data, words."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.session import ensure_checkpoint_dir

#: Byte map: A-Z to a-z; 0-9, a-z and every byte of a non-ASCII character stay; the
#: rest separates words. On UTF-8 this is the class [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256))


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs reread the files, so a lost executor never
    recomputes what came before. The folder is ``spark.checkpoint.dir``. Shuffle
    files of the write go with its end, not with the driver's next collection.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if was is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, was)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session's Python workers get batches of about ``BATCH_BYTES`` at most, however
    long the rows are: a batch is held several times over, as Arrow, as Python texts and as results."""
    given = spark.conf.get(ARROW_BYTES).rstrip("b")
    if not given.isdigit() or int(given) > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text as UTF-8; none for null."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def crc_mod(col: str, m: int) -> Column:
    """crc32 of the column as text, modulo ``m``; null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(m))


def with_columns(schema: T.StructType, fields: list[T.StructField]) -> T.StructType:
    """``schema`` with ``fields`` after it; a field replaces an input column of its name."""
    new = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in new] + fields)


def hash64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Mix uint64 values (splitmix64 finaliser); a bijection for each seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15)
                                            & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def worker_object(key: tuple, make):
    """An object kept for the life of a Python worker (tokenizers, caches), made on first use.

    Functions of this package reach the workers by value, so a module's globals would not
    outlive a task; a module entry does.
    """
    kept = sys.modules.setdefault("_keyweave_worker", types.ModuleType("_keyweave_worker"))
    if key not in kept.__dict__.setdefault("objects", {}):
        kept.objects[key] = make()
    return kept.objects[key]


def worker_free(kind: str) -> None:
    """Give back what this worker keeps under keys of this kind: a worker goes from stage to stage,
    and the next one would hold it for nothing."""
    objects = getattr(sys.modules.get("_keyweave_worker"), "objects", {})
    gone = [objects.pop(key) for key in list(objects) if key[0] == kind]
    if gone:
        del gone
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)


_MULTIPLIER = 0x2545F4914F6CDD1D
_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_BYTE = np.random.default_rng(11).integers(0, 2**64, 256, np.uint64)


_KEPT_POWERS = 1 << 17  # 2 MB in all; longer texts make their own


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of each."""
    def make(size: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for m in (_MULTIPLIER, _INVERSE):
            x = np.full(size, m, np.uint64)
            x[0] = 1
            with np.errstate(over="ignore"):
                out.append(np.multiply.accumulate(x))
        return out[0], out[1]

    if n > _KEPT_POWERS:
        return make(n)
    return worker_object(("powers",), lambda: make(_KEPT_POWERS))


def word_hashes(text: str | None, word_bytes: bytes = WORD_BYTES) -> np.ndarray:
    """64-bit hashes of :func:`words`, all at once: differences of running polynomial sums.

    ``word_bytes`` maps bytes as ``WORD_BYTES`` does, with a space for what separates words.
    """
    if not text:
        return np.empty(0, np.uint64)
    return _raw_hashes(text.encode("utf-8", "surrogatepass").translate(word_bytes))[0]


def many_word_hashes(texts: list[str | None],
                     word_bytes: bytes = WORD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """:func:`word_hashes` of all texts end to end, and how many words each has. Texts are taken
    together up to the size that powers are kept for: short ones cost little more than their bytes."""
    raws = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    hashes, counts, lo, size = [], [], 0, 0
    for i in range(len(raws) + 1):
        if i == len(raws) or size + len(raws[i]) + 1 >= _KEPT_POWERS:
            if lo < i:
                h, start = _raw_hashes(b" ".join([*raws[lo:i], b""]).translate(word_bytes))
                ends = np.cumsum([len(r) + 1 for r in raws[lo:i]])
                hashes.append(h)
                counts.append(np.diff(np.searchsorted(start, ends), prepend=0))
            lo, size = i, 0
        size += len(raws[i]) + 1 if i < len(raws) else 0
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def _raw_hashes(mapped: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words between the spaces of ``mapped``."""
    raw = np.frombuffer(mapped, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = raw != 32
    edge = np.flatnonzero(np.diff(inside))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[:len(raw)], out=sums[1:])
        return hash64((sums[end] - sums[start]) * down[start], 5), start


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive word hashes, in text order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # a polynomial in each run, from those of runs of 1, 2, 4, ... elements
    base, part, w = 0x100000001B3 * 2 + 1, h, 1
    out, m = np.zeros(n, np.uint64), 0
    with np.errstate(over="ignore"):
        while True:
            power = np.uint64(pow(base, w, 2**64))
            if k & w:
                out = out * power + part[m:m + n]
                m += w
            if m == k:
                return hash64(out)
            part = part[:-w] * power + part[w:]
            w *= 2
