"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts become lower-cased runs of letters between single spaces; their character 1- to 3-grams are
hashed into ``2**bits`` buckets, of whole texts. Document frequencies are counted over all
training documents. TF-IDF rows (1 + log tf, normalised) of a bounded sample of labelled rows
(about ``fit_rows`` in the languages' shares, but of each language at least about ``least_rows`` or
all it has, the documented limit of the fit) train the weights with follow-the-regularised-leader
(per-coordinate rates, elastic-net penalty, so that most weights are exactly 0). A fifth of each
language's sample is kept back from that and fits one temperature for the scores.

Edge cases: a text that is null, empty or has no letters is ``und`` with score 0; null languages
are not learnt from; without any labelled document every text is ``und``; with one language all
others get it with score 1; ties go to the first language in order; repeated documents are judged
row by row. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.llm.common import with_columns, worker_free, worker_object

UND = "und"
RESULT = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
SPACE = np.array([32], np.uint32)


def letter_table() -> np.ndarray:
    """For each code point: its lower case if it is a letter, else a space."""
    out = np.full(0x110000, 32, np.uint32)
    for k in range(0x110000):
        ch = chr(k)
        if ch.isalpha():
            low = ch.lower()
            out[k] = ord(low) if len(low) == 1 else k
    return out


def grams(text: str | None, bits: int) -> np.ndarray:
    """Buckets of all character 1- to 3-grams of the text's letters, in no order."""
    if not text:
        return np.empty(0, np.uint32)
    letters = worker_object(("letters",), letter_table)
    c = letters[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    gap = c == 32
    if gap.all():
        return np.empty(0, np.uint32)
    c = np.concatenate([SPACE, c[1:][~(gap[1:] & gap[:-1])]])
    shift = np.uint32(32 - bits)
    with np.errstate(over="ignore"):
        one = c * MIX[0]
        two = (one[:-1] ^ (c[1:] * MIX[1])) * MIX[2]
        three = ((two[:-1] ^ (two[:-1] >> np.uint32(15))) + one[2:]) * MIX[1]
        return np.concatenate([one * MIX[1], two, three * MIX[2]]) >> shift


def counts(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets in order, and how often each occurs."""
    g = grams(text, bits)
    if len(g) > 1 << bits >> 4:
        dense = np.bincount(g, minlength=1 << bits)
        at = np.flatnonzero(dense)
        return at, dense[at]
    return np.unique(g, return_counts=True)


def tfidf(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(n)) * idf[at]
    norm = np.sqrt((v * v).sum())
    return v / norm if norm else v


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # [bucket, language], mostly zeros
    bias: np.ndarray
    temperature: float
    bits: int

    def logits(self, text: str | None) -> np.ndarray | None:
        at, n = counts(text, self.bits)
        if not len(at) or not self.languages:
            return None
        return tfidf(at, n, self.idf) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        z = self.logits(text)
        if z is None:
            return UND, 0.0
        p = _softmax(z / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(min(1.0, p[k]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_buckets: int, n_classes: int, *,
         epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02,
         l2: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader with an elastic-net penalty."""
    z, s = np.zeros((n_buckets + 1, n_classes)), np.zeros((n_buckets + 1, n_classes))

    def weights(at):
        za, sa = z[at], s[at]
        w = -(za - np.sign(za) * l1) / ((beta + np.sqrt(sa)) / alpha + l2)
        return np.where(np.abs(za) <= l1, 0.0, w)

    for _ in range(epochs):
        for at, v, y in rows:
            at, v = np.append(at, n_buckets), np.append(v, 1.0)  # the last one is the bias
            w = weights(at)
            error = _softmax(v @ w)
            error[y] -= 1
            g = v[:, None] * error
            sigma = (np.sqrt(s[at] + g * g) - np.sqrt(s[at])) / alpha
            z[at] += g - sigma * w
            s[at] += g * g
    w = weights(np.arange(n_buckets + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of the least negative log-likelihood (golden section over its log)."""
    def loss(t):
        p = _softmax(logits / np.exp(t))[np.arange(len(y)), y]
        return -np.log(np.maximum(p, 1e-12)).mean()

    lo, hi, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(docs: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", bits: int = 14, fit_rows: int = 5000,
          least_rows: int = 100) -> Model:
    """Fit on documents where ``learn`` holds and the language is known."""
    known = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("id"), F.col(text).alias("t"), F.col(lang).cast("string").alias("y"))

    def frequencies(batches):
        worker_free("ByteBPE")
        df, n = np.zeros(1 << bits, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                at, _ = counts(t, bits)
                df[at] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["g", "df"])

    total = known.select("t").mapInArrow(frequencies, "g long, df long").groupBy("g").agg(
        F.sum("df").alias("df")).toArrow()  # at most 2**bits + 1 rows
    df = dict(zip(total.column("g").to_pylist(), total.column("df").to_pylist(), strict=True))
    n_docs = df.pop(-1, 0)
    idf = np.zeros(1 << bits)
    if df:
        idf[list(df)] = np.log((1 + n_docs) / (1 + np.array(list(df.values())))) + 1

    # a row's place between 0 and 1; rows that repeat id and text are one
    place = F.pmod(F.xxhash64("id", "t", F.lit(4)), F.lit(1 << 40)) / float(1 << 40)
    per = known.groupBy("y").agg(F.count("*").alias("n"), F.min(place).alias("first")).collect()
    n_rows = sum(r.n for r in per)
    share = {r.y: max(fit_rows / n_rows, least_rows / r.n, r.first) for r in per}

    def rows(batches):
        for b in batches:
            c = [counts(t, bits) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0].astype(np.int32) for x in c], pa.list_(pa.int32())),
                 pa.array([x[1].astype(np.int32) for x in c], pa.list_(pa.int32())),
                 b.column(2)], names=["id", "at", "n", "y"])

    if not per:
        return Model([], idf, np.zeros((1 << bits, 0)), np.zeros(0), 1.0, bits)
    kind = dict(known.dtypes)["id"]
    shares = known.sparkSession.createDataFrame(list(share.items()), "s_y string, share double")
    sample = known.join(F.broadcast(shares), F.col("y") == F.col("s_y")).where(
        place <= F.col("share")).select("id", "t", "y").dropDuplicates().mapInArrow(
        rows, f"id {kind}, at array<int>, n array<int>, y string").toArrow()
    sample = sample.sort_by([("id", "ascending"), ("y", "ascending")])
    languages = sorted(set(sample.column("y").to_pylist()))
    data = []
    for at, n, y in zip(sample.column("at"), sample.column("n"), sample.column("y"), strict=True):
        a = at.values.to_numpy()
        if len(a):
            data.append((a, tfidf(a, n.values.to_numpy(), idf), languages.index(y.as_py())))
    np.random.default_rng(7).shuffle(data)
    seen, kept, fit = [0] * len(languages), [], []
    for row in data:  # every fifth row of a language is kept back
        seen[row[2]] += 1
        (fit if seen[row[2]] % 5 else kept).append(row)
    w, bias = ftrl(fit, 1 << bits, len(languages))
    temperature = 1.0
    if kept and len(languages) > 1:
        z = np.array([v @ w[at] + bias for at, v, _ in kept])
        temperature = fit_temperature(z, np.array([y for *_, y in kept]))
    return Model(languages, idf, w, bias, temperature, bits)


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    schema = with_columns(docs.schema, RESULT)
    keep = schema.fieldNames()[:-2]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits rows of one column a language

    def run(batches):
        m = shared.value
        for b in batches:
            p = [m.predict(t) for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in keep),
                 pa.array([x[0] for x in p], pa.string()),
                 pa.array([x[1] for x in p], pa.float64())], names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, *, text: str = "text",
             min_score: float = 0.5) -> DataFrame:
    """The documents whose language is known with at least ``min_score``; columns as they were.

    Without a fitted language only texts without letters go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def keep(batches):
        m = shared.value
        for b in batches:
            texts = b.column(at).to_pylist()
            if m.languages:
                good = [p[0] != UND and p[1] >= min_score for p in map(m.predict, texts)]
            else:
                good = [len(grams(t, m.bits)) > 0 for t in texts]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def labelled(docs: DataFrame, model: Model, *, text: str = "text", lang: str = "lang",
             min_score: float = 0.5) -> DataFrame:
    """The documents with letters, each with its language; columns as they were.

    ``lang`` becomes the predicted language where that has at least ``min_score`` or none is
    given; less sure predictions leave the given one. Without a fitted language it stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, own = docs.columns.index(text), docs.columns.index(lang)

    def label(batches):
        worker_free("ByteBPE")
        m = shared.value
        for b in batches:
            texts, given = b.column(at).to_pylist(), b.column(own)
            if m.languages:
                found = [m.predict(t) for t in texts]
                good = [y != UND for y, _ in found]
                named = pa.array([y if p >= min_score or old is None else str(old) for (y, p), old
                                  in zip(found, given.to_pylist(), strict=True)], pa.string())
                b = b.set_column(own, b.schema.field(own), named.cast(given.type))
            else:
                good = [len(grams(t, m.bits)) > 0 for t in texts]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(label, docs.schema)
