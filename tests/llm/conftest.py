from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b + c for a in "bcdfglmnprst" for b in "aeiou" for c in ("", "n", "ra", "sti", "lo")]


def prose(seed: int, n: int) -> str:
    """n words in sentences, the same for the same seed."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = rng.choice(WORDS) + rng.choice(WORDS)
        out.append(w + (". " if i % 9 == 8 else " "))
    return "".join(out).strip()


@pytest.fixture(scope="session")
def documents(spark):
    def build(rows):
        """Rows (doc_id, text[, lang[, source]])."""
        full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame(
            [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in full], SCHEMA)
    return build


# null ids and texts, empty and blank texts, a repeated row, one very long text
def odd_rows(long_words: int = 30_000):
    return [(None, prose(1, 60), "en"), (1, None, None), (2, "", "en"), (3, " \n\t ", None),
            (4, "!!! ??? 123", "en"), (5, prose(5, 80), "en"), (5, prose(5, 80), "en"),
            (6, prose(6, long_words), "en"), (7, "x", None)]
