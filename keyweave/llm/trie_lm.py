"""Language-model scores from an Elias-Fano n-gram trie.

Texts are lower-cased (A-Z) words between ASCII white space and one end token; the end token
stands before the first word too. The model interpolates each order with the one below (Dirichlet
prior): P(w | ctx) = (c(ctx w) + mu * P(w | shorter ctx)) / (c(ctx) + mu), over add-one unigrams.

The n-grams of all training documents are counted, none is dropped, and no worker holds the whole
model. Documents belong to blocks of bounded size (by their file and a hash of their id):

1. Each task sends the distinct n-grams of its blocks, with their counts in training documents, to
   shards: ranges of 64-bit n-gram hashes, packed into one row for a block and shard. An n-gram
   is sent once for a block however often it occurs, so frequent ones make no large group. The
   ``BOOK`` most frequent words of the input have 16-bit codes; an n-gram of such words goes by
   its codes in place of a hash, in levels of their own (numbered -n), which leaves steps of 2
   to 4 bytes between a block's keys in place of 7. Which words have codes changes no count.
2. A shard adds up its n-grams over all blocks and sends the totals back to the blocks that
   asked; the number of shards grows with the input.
3. A block then has the training counts of all its n-grams: its part of the model. It builds them
   into a trie (see ``elias_fano``: monotone sequences and pointers, quantised smoothed
   probabilities and back-offs, memory-mapped levels) and scores its documents, finding each
   n-gram by a successor search relative to its context; those not in the trie back off.

Edge cases: null and empty texts are the end token alone; without training documents all counts
are 0 and unknown words share one probability; repeated documents are scored row by row; null
ids count as not held out only as the caller's ``learn`` says; very long texts are used in whole.
Input columns other than id and text are not read. ``docs`` must be read from files (then their
names give the blocks); others are written first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.common import hash64, many_word_hashes, materialise
from keyweave.llm.elias_fano import Trie

#: Byte map: A-Z to a-z, ASCII white space to a space; all other bytes are of words.
TOKEN_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b
                    for b in range(256))
END = np.array([0x5EED0FE0DD0C0DE5], np.uint64)  # stands for the end token; no word's hash
BOOK = 1 << 16  # words with codes
ASK = "level int, shard int, block long, low long, key_width int, keys binary, counts binary"
TOLD = "level int, shard int, block long, width int, counts binary, n_tokens long, n_types long"
RESULT = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def encode(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes: END, then each text's words and END; starts of the texts).

    Text i is h[starts[i]:starts[i + 1]] with the END before it at starts[i] - 1.
    """
    words, n = many_word_hashes(texts, TOKEN_BYTES)
    h = np.repeat(END, 1 + len(words) + len(texts))
    h[np.arange(1, 1 + len(words)) + np.repeat(np.arange(len(texts)), n)] = words
    return h, np.concatenate([[1], 1 + np.cumsum(n + 1)])


def code_book(texts: DataFrame, text: str) -> np.ndarray:
    """Hashes of the most frequent words (and END) in order; a word's code is its place."""
    def run(batches):
        for b in batches:
            words, n = np.unique(encode(b.column(0).to_pylist())[0][1:], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)],
                                             names=["word", "n"])

    top = texts.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(BOOK).toArrow()
    return np.sort(top.column("word").to_numpy().view(np.uint64))


def in_order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of uint64 keys in their order, equal ones by place; the keys in order).

    The keys' upper bits are sorted with the places in the lower ones: a sort takes less than half
    of an argsort's time. Keys that differ only in the bits that gave way are put right after it.
    """
    n = len(keys)
    if not n:
        return np.empty(0, np.int64), keys
    low, high = keys.min(), keys.max()
    bits = np.uint64((n - 1).bit_length())
    up = np.uint64(64 - int(high - low).bit_length()) if high > low else np.uint64(0)
    packed = (keys - low) << up >> bits << bits | np.arange(n, dtype=np.uint64)
    packed.sort()
    order = (packed & np.uint64((1 << int(bits)) - 1)).view(np.int64)
    out = keys[order]
    wrong = np.flatnonzero(out[1:] < out[:-1])
    if len(wrong) > 1000:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    if len(wrong):
        packed >>= bits
        for lo, hi in sorted({tuple(np.searchsorted(packed, packed[i] + np.uint64([0, 1])).tolist())
                              for i in wrong}):
            order[lo:hi] = order[lo:hi][np.argsort(out[lo:hi], kind="stable")]
            out[lo:hi] = keys[order[lo:hi]]
    return order, out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct key, in the keys' order; each key's number among the distinct)."""
    order, keys = in_order(keys)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    inverse = np.empty(len(keys), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return order[new], inverse


def book_places(book: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Where the hashes are in the book, -1 for those that are not. Hashes are spread evenly: their
    first bits lead next to the place, and a few steps to it."""
    slots = np.uint64(64 - 18)
    starts = np.concatenate([[0], np.cumsum(np.bincount((book >> slots).astype(np.int64),
                                                        minlength=1 << 18))]).astype(np.int32)
    slot = (h >> slots).astype(np.int32)
    place, end = starts[slot], starts[slot + 1]
    found = np.full(len(h), -1, np.int32)
    left = np.flatnonzero(place < end)
    place, end = place[left], end[left]
    while len(left):
        here = book[place] == h[left]
        found[left[here]] = place[here]
        place += 1
        more = ~here & (place < end)
        left, place, end = left[more], place[more], end[more]
    return found


def _mixed(code: np.ndarray, n: int) -> np.ndarray:
    """Codes of n words spread over all 64-bit keys that end in 64 - 16 n zeros; a bijection."""
    top, half = np.uint64(64 - 16 * n), np.uint64(8 * n)
    with np.errstate(over="ignore"):
        code = (code * np.uint64(0x9E3779B97F4A7C15)) << top >> top
        code ^= code >> half
        return (code * np.uint64(0xBF58476D1CE4E5B9)) << top


def ngram_keys(h: np.ndarray, order: int, book: np.ndarray | None = None):
    """By level: (positions whose n-gram stays inside one text, their 64-bit keys, which of them
    are mixed codes), to be used before the next level is asked for."""
    key = hash64(h, 1)
    at = np.arange(1, len(h), dtype=np.int32)
    yield at, key[1:], np.zeros(len(at), bool)
    ends = np.cumsum(h == END[0], dtype=np.int32)
    if book is None or not len(book):
        known, word = np.zeros(len(h), bool), np.zeros(len(h), np.uint64)
    else:
        place = book_places(book, h)
        known, word = place >= 0, np.maximum(place, 0).astype(np.uint64)
    coded, code = known, word
    for n in range(2, order + 1):
        with np.errstate(over="ignore"):
            key[1:] = hash64(key[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:], n)
        at = np.arange(n - 1, len(h), dtype=np.int32)
        # no END but as the first or the last token
        if n > 2:
            at = at[ends[at - 1] == ends[at - n + 1]]
        if n > 4:  # four codes fill a key
            yield at, key[at], np.zeros(len(at), bool)
            continue
        coded, code = coded.copy(), code.copy()
        coded[1:], code[1:] = coded[:-1] & known[1:], code[:-1] << np.uint64(16) | word[1:]
        short = coded[at]
        yield at, np.where(short, _mixed(code[at], n), key[at]), short


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their weights."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    order, keys = in_order(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights[order].astype(np.int64), first)


def _narrow(counts: np.ndarray) -> np.ndarray:
    top = int(counts.max(initial=0))
    return counts.astype("<u1" if top < 256 else "<u2" if top < 65536 else "<u8")


def _zeros(level: int) -> int:
    """The zero bits that all keys of a level end in."""
    return 64 + 16 * level if level < 0 else 0


def pack_keys(keys: np.ndarray, zeros: int = 0) -> tuple[int, bytes]:
    """Increasing keys that end in ``zeros`` zero bits as (byte width, steps from the first key in
    so many bytes each, first all lowest bytes, then the next ones)."""
    steps = np.diff(keys, prepend=keys[:1]) >> np.uint64(zeros)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return width, steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_keys(first: int, width: int, raw: bytes, zeros: int = 0) -> np.ndarray:
    steps = np.zeros((len(raw) // width, 8), np.uint8)
    steps[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    steps = steps.view(np.uint64)[:, 0] << np.uint64(zeros)
    steps[0] = first & 0xFFFFFFFFFFFFFFFF
    return np.cumsum(steps, dtype=np.uint64)


def _ask(order: int, shards: int, flush_chars: int, book):
    """mapInArrow function over (block, text, learn): ASK rows."""
    width = -(-2**64 // shards)
    edges = np.array([width * s for s in range(1, shards)], np.uint64)

    def send(blocks, texts, learn):
        out: list[list] = [[], [], [], [], [], [], []]
        by_block: dict[int, list[int]] = {}
        for i, b in enumerate(blocks):
            by_block.setdefault(b, []).append(i)
        for block, rows in by_block.items():
            h, starts = encode([texts[i] for i in rows])
            used = np.zeros(len(h), bool)
            for i, lo, hi in zip(rows, starts[:-1], starts[1:], strict=True):
                used[lo:hi] = learn[i]
            for n, (at, key, short) in enumerate(ngram_keys(h, order, book.value), 1):
                for level, mine in ((n, ~short), (-n, short)):
                    keys, counts = _sums(key[mine], used[at[mine]])
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    for s, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        if lo < hi:
                            row = (level, s, block, int(keys[lo:lo + 1].view(np.int64)[0]),
                                   *pack_keys(keys[lo:hi], _zeros(level)),
                                   _narrow(counts[lo:hi]).tobytes())
                            for col, v in zip(out, row, strict=True):
                                col.append(v)
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
                 pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
            names=["level", "shard", "block", "low", "key_width", "keys", "counts"])

    def ask(batches):
        blocks, texts, learn, size = [], [], [], 0
        for b in batches:
            for block, text, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                blocks.append(block)
                texts.append(text)
                learn.append(own)
                size += len(text or "")
                if size >= flush_chars:
                    yield send(blocks, texts, learn)
                    blocks, texts, learn, size = [], [], [], 0
        yield send(blocks, texts, learn)

    return ask


def _total(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One shard: the totals of its n-grams, for each block in the order of its keys."""
    level, shard = key[0].as_py(), key[1].as_py()
    blocks = table.column("block").to_numpy()
    keys = [unpack_keys(*row, _zeros(level)) for row in zip(*(
        table.column(c).to_pylist() for c in ("low", "key_width", "keys")), strict=True)]
    counts = [np.frombuffer(c, f"<u{len(c) // len(k)}")
              for c, k in zip(table.column("counts").to_pylist(), keys, strict=True)]
    entry, number = distinct(np.concatenate(keys))
    totals = np.zeros(len(entry), np.int64)
    ends = np.cumsum([len(k) for k in keys])
    places = np.split(number, ends[:-1])
    for place, c in zip(places, counts, strict=True):
        totals[place] += c.astype(np.int64)  # a row's keys are distinct
    out: list[list] = [[], [], []]
    order = np.argsort(blocks, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(blocks[order])) + 1):
        own = places[at[0]]
        if len(at) > 1:  # sorted: np.unique alone hashes, which takes many times longer
            own = np.sort(np.concatenate([places[i] for i in at]))
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        told = _narrow(totals[own])
        out[0].append(int(blocks[at[0]]))
        out[1].append(told.itemsize)
        out[2].append(told.tobytes())
    m = len(out[0])
    first = lambda v: pa.array([int(v)] + [0] * (m - 1), pa.int64())
    return pa.table([pa.array([level] * m, pa.int32()), pa.array([shard] * m, pa.int32()),
                     pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                     pa.array(out[2], pa.binary()), first(totals.sum()), first((totals > 0).sum())],
                    names=["level", "shard", "block", "width", "counts", "n_tokens", "n_types"])


def _codes(node: np.ndarray, word: np.ndarray, n_words: int) -> np.ndarray:
    return (node.astype(np.int64) * n_words + word).view(np.uint64)


def build(x: np.ndarray, at: list[np.ndarray], inverse: list[np.ndarray],
          counts: list[np.ndarray], n_total: int, n_types: int, mu: float) -> Trie:
    """The block's trie.

    ``inverse`` and ``counts`` give, by level, each position's distinct n-gram and its count.
    """
    trie = Trie()
    word_count = counts[0] if len(counts[0]) else np.zeros(1, np.int64)
    p = (word_count + 1) / (n_total + n_types + 1)
    trie.add_words(np.log10(p), np.log10(mu / (word_count + mu)))
    # exact probability by position at the order so far, for the next order's entries; each
    # position's node at that order (-1: not in the trie)
    exact = p[x]
    node = np.where(word_count[x] > 0, x, np.int32(-1))
    context_count = word_count
    for n in range(2, len(at) + 1):
        pos, inv, c = at[n - 1], inverse[n - 1], counts[n - 1]
        # a position of each distinct n-gram; those with a count, by context node and word
        entry = np.empty(len(c), pos.dtype)
        entry[inv] = pos
        seen = np.flatnonzero(c > 0)
        seen = seen[in_order(_codes(node[entry[seen] - 1], x[entry[seen]], len(word_count)))[0]]
        context, below = node[entry - 1], exact[entry]
        own, over = c[seen], context[seen]
        prob = (own + mu * below[seen]) / (context_count[over] + mu)
        trie.add_level(over.astype(np.int64), x[entry[seen]].astype(np.int64),
                       len(trie.prob[-1].codes), np.log10(prob), np.log10(mu / (own + mu)))
        if n == len(at):
            break  # no level asks for the nodes of the last one
        rank = np.full(len(c), -1, np.int32)
        rank[seen] = np.arange(len(seen))
        # an unseen n-gram whose context is known has the backed-off probability
        chance = np.where(context >= 0, mu / (context_count[np.maximum(context, 0)] + mu),
                          1.0) * below
        chance[seen] = prob
        exact[pos] = chance[inv]
        node = np.full(len(x), -1, np.int32)
        node[pos] = rank[inv]
        context_count = own
    return trie


def trie_scores(trie: Trie, x: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
    """log10 P of each position's word in its context, looked up in the trie."""
    score = trie.prob[0].at(x)
    node = x  # unigram nodes: word ids; unknown words have count 0 there
    n_words = len(trie.prob[0].codes)
    for n in range(2, len(at) + 1):
        own = at[n - 1]
        own = own[node[own - 1] >= 0]
        # each context and word once and in order: the searches go on from place to place
        entry, inv = distinct(_codes(node[own - 1], x[own], n_words))
        entry = own[entry]
        context, word = node[entry - 1], x[entry]
        child = np.empty(len(entry), np.int32)
        for lo in range(0, len(entry), 1 << 18):  # the search makes many arrays of this length
            part = slice(lo, lo + (1 << 18))
            child[part] = trie.child(n, context[part], word[part])
        chance = trie.back[n - 2].at(context) + score[entry]
        known = np.flatnonzero(child >= 0)
        chance[known] = trie.prob[n - 1].at(child[known])
        score[own] = chance[inv]
        if n < len(at):
            node = np.full(len(x), -1, np.int32)
            node[own] = child[inv]
    return score


def _score(order: int, n_total: int, n_types: int, mu: float, book):
    """cogroup function: one block's documents and the counts of their n-grams."""
    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        h, starts = encode(docs.column("text").to_pylist())
        width, raw = told.column("width").to_pylist(), told.column("counts").to_pylist()
        where = np.lexsort((told.column("shard").to_numpy(), told.column("level").to_numpy()))
        level = told.column("level").to_numpy()
        at, inverse, counts = [], [], []
        for n, (pos, key, short) in enumerate(ngram_keys(h, order, book.value), 1):
            inv, own, n_distinct = np.empty(len(key), np.int32), [], 0
            for lev, mine in ((n, ~short), (-n, short)):
                places, numbers = distinct(key[mine])
                inv[mine] = numbers + np.int32(n_distinct)
                n_distinct += len(places)
                own += [np.frombuffer(raw[i], f"<u{width[i]}").astype(np.int64)
                        for i in where if level[i] == lev]
            at.append(pos)
            inverse.append(inv)
            counts.append(np.concatenate(own) if own else np.empty(0, np.int64))
            if len(counts[-1]) != n_distinct:
                raise RuntimeError("a block's n-grams differ between two reads of the input")
        # word ids: places of the distinct unigrams; the first END is as the last
        x = np.concatenate([inverse[0][-1:], inverse[0]]) if docs.num_rows else np.zeros(1, np.int32)
        word_count = counts[0] if len(counts[0]) else np.zeros(1, np.int64)
        base = np.log10((word_count + 1) / (n_total + n_types + 1))[x]
        model = trie_scores(build(x, at, inverse, counts, n_total, n_types, mu), x, at)
        ends = starts[1:]
        add = lambda v: np.array([v[lo:hi].sum() for lo, hi in zip(
            starts[:-1], ends, strict=True)], v.dtype)
        return pa.table(
            [docs.column("doc_id"), docs.column("learn"), pa.array(ends - starts[:-1]),
             pa.array(add((word_count > 0).astype(np.int64)[x])),
             pa.array(np.full(docs.num_rows, n_total, np.int64)), pa.array(add(base)),
             pa.array(add(model))],
            names=["doc_id", "learn", "n_tokens", "n_known", "train_tokens", "base_score",
                   "score"])
    return score


def lm_scores(docs: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text",
              order: int = 2, mu: float = 64.0, block_bytes: int = 4_000_000,
              shard_bytes: int = 8_000_000, on_files: bool = False) -> DataFrame:
    """doc_id, learn, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows where ``learn`` holds. ``on_files`` says that ``docs`` is a
    table as read from files; else it is written first. ``block_bytes`` and ``shard_bytes`` are
    the input bytes that a block and a shard stand for.
    """
    if not on_files:
        docs = materialise(docs, "lm-docs")
    file = docs.select(F.col("_metadata.file_path").alias("f"),
                       F.col("_metadata.file_size").alias("s")).groupBy("f").agg(F.max("s").alias("s"))
    size = file.agg(F.sum("s")).first()[0] or 0
    shards = max(16, -(-size // shard_bytes))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_metadata.file_size") / block_bytes))
    block = F.xxhash64(F.col("_metadata.file_path"),
                       F.pmod(F.xxhash64(F.col(doc_id)), parts))
    rows = docs.select(block.alias("block"), F.col(doc_id).alias("doc_id"),
                       F.col(text).alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))
    book = docs.sparkSession.sparkContext.broadcast(code_book(docs, text))  # half a MB
    asked = rows.select("block", "text", "learn").mapInArrow(
        _ask(order, shards, 2 * block_bytes, book), ASK)
    told = materialise(asked.groupBy("level", "shard").applyInArrow(_total, TOLD), "lm-counts")
    n = told.where("level = 1").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t"),
                                    F.coalesce(F.sum("n_types"), F.lit(0)).alias("v")).first()
    kind = dict(rows.dtypes)["doc_id"]
    return rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _score(order, n.t, n.v, mu, book), f"doc_id {kind}, learn boolean, {RESULT}")
