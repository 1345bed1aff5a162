from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import pytest

from keyweave.llm.packing import ByteBPE, pack, shortest_pack_first
from tests.llm.conftest import odd_rows, prose

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer(plain):
    texts = [prose(1, 300), "a  b", "x \n y", "\n\n q", "é  ", "", " lead", "tab\t x", "a b c",
             "it's we're 12 34 ...", "Ωμέγα και 漢字 word", "<|endoftext|> a <|endoftext|>",
             "trail ", "  ", "a  b", "x" * 300 + " y", "\U0001f600 ok", "naïve\r\n line"]
    bpe = ByteBPE(PATH)
    for _ in range(2):  # the second time from the cache
        for t in texts:
            ids = plain(t)
            assert bpe.ids(t) == struct.pack(f"<{len(ids)}I", *ids), repr(t)


def test_patterns_use_every_piece_once():
    histogram = {2048: 3, 1500: 10, 1000: 7, 548: 9, 100: 40, 1: 5}
    used = defaultdict(int)
    for count, pattern in shortest_pack_first(histogram, 2048):
        assert sum(pattern) <= 2048 and pattern == sorted(pattern, reverse=True)
        for length in pattern:
            used[length] += count
    assert used == histogram
    assert shortest_pack_first({}, 2048) == []


def test_pieces_round_trip(spark, documents, plain):
    rows = odd_rows(9000) + [(100 + i, prose(i, 30 + 7 * i)) for i in range(150)]
    rows += [(1000 + i, prose(3, 90)) for i in range(300)]  # one length for very many documents
    out = pack(documents(rows), PATH).collect()
    ids = defaultdict(list)
    for doc_id, text, *_ in rows:
        ids[doc_id].append(plain(text or "") + [1])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for doc_id, texts in ids.items():
        total = len(texts[0])
        got = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert all(r.doc_tokens == total for r in got)
        assert sum(r.length for r in got) == total * len(texts)
        for r in got:
            part = texts[0][r.start:r.start + r.length]
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sum(r.length for r in out) > 0.97 * 2048 * len(by_sequence)


def test_empty_table(spark, documents):
    assert pack(documents([]), PATH).count() == 0


def test_added_tokens_as_in_the_file(spark, documents):
    file = tokenizers.Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext", prose(2, 50),
             prose(3, 1200) + " <|endoftext|> " + prose(4, 1200)]
    ids = [file.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert ids[0] == [64, 220, 50256, 275, 1]
    out = pack(documents(list(enumerate(texts))), PATH).collect()
    assert {r.doc_id for r in out} == set(range(len(texts)))
    for r in out:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32
