from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyweave.llm.elias_fano import EliasFano, Quantised, Trie, mapped
from keyweave.llm.trie_lm import (
    _narrow,
    _total,
    _zeros,
    book_places,
    distinct,
    encode,
    in_order,
    lm_scores,
    ngram_keys,
    pack_keys,
    unpack_keys,
)
from tests.llm.conftest import odd_rows, prose


def test_elias_fano_access_and_successor():
    rng = np.random.default_rng(0)
    for _ in range(200):
        top = int(rng.choice([3, 50, 1000, 10**6, 2**40]))
        v = np.sort(rng.integers(0, top, rng.integers(1, 300))).astype(np.uint64)
        e = EliasFano.of(v)
        e.parts = mapped(e.parts)
        assert (e.access(np.arange(len(v))) == v).all()
        q = np.concatenate([v, rng.integers(0, 2 * top + 2, 100).astype(np.uint64)])
        assert (e.successor(q) == np.searchsorted(v, q)).all()


def test_trie_children():
    rng = np.random.default_rng(1)
    for _ in range(50):
        contexts, words = int(rng.integers(1, 30)), int(rng.integers(1, 40))
        nodes = sorted({(int(a), int(b)) for a, b in zip(
            rng.integers(0, contexts, 60), rng.integers(0, words, 60), strict=True)})
        c, w = np.array(nodes).T
        t = Trie()
        t.add_words(np.zeros(words), np.zeros(words))
        t.add_level(c, w, contexts, np.zeros(len(c)), np.zeros(len(c)))
        ctx, word = (a.ravel() for a in np.meshgrid(np.arange(-1, contexts), np.arange(words)))
        where = {n: i for i, n in enumerate(nodes)}
        assert t.child(2, ctx, word).tolist() == [where.get(n, -1) for n in zip(
            ctx.tolist(), word.tolist(), strict=True)]


def test_quantised_steps():
    v = np.linspace(-9, -1, 1000)
    assert np.abs(Quantised(v).at(np.arange(1000)) - v).max() < 1e-4
    assert Quantised(np.full(3, -2.5)).at(np.array([0, 2])).tolist() == [-2.5, -2.5]


@pytest.mark.parametrize("spread", [2**64 - 1, 2**40, 50, 1])
def test_order_and_distinct_keys(spread):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 5000):
        keys = rng.integers(0, spread, n, np.uint64)
        # keys that differ in their last bits only, where the places go
        for many in (40, n):
            keys = np.concatenate([keys, keys[:many] ^ np.uint64(1), keys[:many] ^ np.uint64(2)])
        order, got = in_order(keys)
        assert order.tolist() == np.argsort(keys, kind="stable").tolist()
        assert (got == np.sort(keys)).all()
        want, inverse = np.unique(keys, return_inverse=True)
        at, numbers = distinct(keys)
        assert (keys[at] == want).all() and (numbers == inverse).all()


def test_places_in_the_book():
    rng = np.random.default_rng(4)
    book = np.unique(np.concatenate([rng.integers(0, 2**64 - 1, 3000, np.uint64),
                                     np.arange(7, 60, dtype=np.uint64),  # one crowded slot
                                     np.array([0, 2**64 - 1], np.uint64)]))
    h = np.concatenate([book, rng.integers(0, 2**64 - 1, 3000, np.uint64),
                        np.arange(100, dtype=np.uint64)])
    where = {int(v): i for i, v in enumerate(book)}
    assert book_places(book, h).tolist() == [where.get(int(v), -1) for v in h]


def test_totals_of_a_block_in_pieces(monkeypatch):
    # pieces of one block meet by sorted places, never by a hash table of all their keys
    def hashed(*_, **__):
        raise AssertionError("np.unique")

    monkeypatch.setattr(np, "unique", hashed)
    pieces = [(5, [3, 9, 2**63], [1, 0, 300]), (6, [9], [2]), (5, [3, 10], [4, 0])]
    rows = [(1, 0, b, k[0], *pack_keys(np.array(k, np.uint64)), _narrow(np.array(c)).tobytes())
            for b, k, c in pieces]
    names = ["level", "shard", "block", "low", "key_width", "keys", "counts"]
    out = _total((pa.scalar(1), pa.scalar(0)),
                 pa.table([list(c) for c in zip(*rows, strict=True)], names=names)).to_pylist()
    told = {r["block"]: np.frombuffer(r["counts"], f"<u{r['width']}").tolist() for r in out}
    assert told == {5: [5, 2, 0, 300], 6: [2]}
    assert sum(r["n_tokens"] for r in out) == 307 and sum(r["n_types"] for r in out) == 3


def brute(rows, learn, order, mu):
    texts = [(t or "").encode().lower().split() + [b" "] for _, t, *_ in rows]
    c = [Counter() for _ in range(order + 1)]
    for use, ws in zip(learn, texts, strict=True):
        if use:
            ws = [b" ", *ws]
            for n in range(1, order + 1):
                first = 1 if n == 1 else 0
                c[n].update(tuple(ws[i:i + n]) for i in range(first, len(ws) - n + 1))
    total, types = sum(c[1].values()), len(c[1])
    out = []
    for ws in texts:
        base = score = 0.0
        padded = [b" ", *ws]
        for i in range(1, len(padded)):
            p = (c[1][(padded[i],)] + 1) / (total + types + 1)
            base += math.log10(p)
            for n in range(2, min(order, i + 1) + 1):
                gram = tuple(padded[i - n + 1:i + 1])
                ctx = c[n - 1][gram[:-1]]
                p = (c[n][gram] + mu * p) / (ctx + mu) if ctx else p
            score += math.log10(p)
        out.append((len(ws), sum(c[1][(w,)] > 0 for w in ws), total, base, score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, documents, order):
    rows = odd_rows(3000) + [(100 + i, prose(i % 17, 20 + i)) for i in range(60)]
    rows += [(200, "The THE the é É"), (201, "the x the\x1fy")]
    learn = [i is not None and i % 3 != 2 for i, *_ in rows]
    out = lm_scores(documents(rows), F.col("doc_id") % 3 != 2, order=order, mu=8.0,
                    block_bytes=5_000).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got = sorted(((r.doc_id, r.learn, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                  for r in out), key=key)
    want = sorted(((r[0], use, *b) for r, use, b in zip(
        rows, learn, brute(rows, learn, order, 8.0), strict=True)), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert abs(g[5] - w[5]) < 1e-6 * (1 + abs(w[5]))
        assert abs(g[6] - w[6]) < 1e-3 * (1 + w[2])


def test_empty_table_and_no_training_rows(spark, documents):
    assert lm_scores(documents([]), F.lit(True)).count() == 0
    [r] = lm_scores(documents([(1, "a b")]), F.lit(False)).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_registered_query_uses_contexts_of_two_words(spark, documents):
    from keyweave.llm.common import crc_mod
    from keyweave.llm.queries import op10_trie_lm
    from keyweave.session import ensure_checkpoint_dir

    sf_dir = f"{ensure_checkpoint_dir(spark)}/lm-query"
    documents([(i, prose(i % 20, 80)) for i in range(60)]).write.mode("overwrite").parquet(
        f"{sf_dir}/documents.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.score for r in op10_trie_lm(spark, sf_dir).collect()}
    want = {r.doc_id: r.score for r in lm_scores(docs, crc_mod("doc_id", 7) != 2, order=3).collect()}
    assert got == pytest.approx(want)


def test_codes_of_frequent_words_make_the_exchange_small():
    texts = [prose(i, 4000) for i in range(10)]
    h, _ = encode(texts)
    book = np.unique(h)[::2]
    for n, ((at, plain, none), (at2, key, short)) in enumerate(
            zip(ngram_keys(h.copy(), 3), ngram_keys(h.copy(), 3, book), strict=True), 1):
        assert (at == at2).all() and not none.any()
        known = np.isin(h, book)
        assert (short == (n > 1) & np.all([known[at - j] for j in range(n)], axis=0)).all()
        # the same n-grams are one, coded or not
        pairs = np.unique(np.column_stack([plain, key, short]), axis=0)
        assert len(pairs) == len(np.unique(plain)) == len(np.unique(key[short])) + len(
            np.unique(key[~short]))
        for level, keys in ((n, np.unique(key[~short])), (-n, np.unique(key[short]))):
            if len(keys):
                zeros = _zeros(level)
                width, raw = pack_keys(keys, zeros)
                assert (unpack_keys(int(keys[0]), width, raw, zeros) == keys).all()
    # a block's bigrams of words with codes: at most 3 bytes each, of hashes 7
    *_, (_, key, short) = ngram_keys(h.copy(), 2, np.unique(h))
    assert short.all()
    assert pack_keys(np.unique(key), _zeros(-2))[0] <= 3


def test_trie_is_asked_for_each_context_and_word_once(monkeypatch):
    from keyweave.llm.trie_lm import build, trie_scores

    h, _ = encode([prose(i % 5, 200) for i in range(40)])
    at, inverse, counts = [], [], []
    for pos, key, _ in ngram_keys(h.copy(), 3):
        _, inv, n = np.unique(key, return_inverse=True, return_counts=True)
        at.append(pos)
        inverse.append(inv.astype(np.int32))
        counts.append(n)
    x = np.concatenate([inverse[0][-1:], inverse[0]])
    asked, child = [], Trie.child

    def count(trie, level, context, word):
        asked.append((level, len(word)))
        return child(trie, level, context, word)

    monkeypatch.setattr(Trie, "child", count)
    trie_scores(build(x, at, inverse, counts, len(h), len(counts[0]), 64.0), x, at)
    assert asked == [(n, len(counts[n - 1])) for n in (2, 3)]
    assert len(counts[2]) < len(at[2]) / 4
