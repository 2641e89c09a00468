"""Decontamination: tiling against brute force, planted passages, slices, odd rows."""

import random
import re

import numpy as np
import pytest

from skywell.llm import decontaminate
from skywell.llm.common import shingles, word_hashes
from skywell.llm.decontaminate import Items, decontaminated, find_contamination
from tests.compare import database


def brute(text, item, least):
    """Words of `item` in greedy tiles: the longest match of free words, first in the text, then in the item."""
    used_t, used_i = [False] * len(text), [False] * len(item)
    while True:
        best = (0, 0, 0)
        for d in range(len(text)):
            for j in range(len(item)):
                n = 0
                while (d + n < len(text) and j + n < len(item) and text[d + n] == item[j + n] and not used_t[d + n] and not used_i[j + n]):
                    n += 1
                if n > best[0]:
                    best = (n, d, j)
        n, d, j = best
        if n < least:
            return sum(used_i)
        used_t[d : d + n] = [True] * n
        used_i[j : j + n] = [True] * n


@pytest.mark.parametrize("letters", [1, 2, 4, 30])
def test_tiles_equal_brute_force(letters):
    r = random.Random(letters)
    for _ in range(60):
        item = [f"w{r.randrange(letters)}" for _ in range(r.randint(1, 14))]
        text = [f"w{r.randrange(letters)}" for _ in range(r.randint(0, 10))]
        for _ in range(r.randint(0, 3)):
            a = r.randrange(len(item))
            text += item[a : a + r.randint(1, 9)] + [f"x{r.random()}"][: r.randint(0, 1)]
        size = 3
        known = Items([0], [word_hashes(" ".join(item))], size)
        got = [n for _, n, _ in known.covered(word_hashes(" ".join(text)))]
        want = brute(text, item, min(size, len(item)))
        assert (got or [0]) == [want], (text, item)


def test_words():
    a = word_hashes("The cat's, RÉSUMÉ\tan-d\x00x ...")
    assert len(a) == 7 and np.array_equal(a, word_hashes("the CAT s résumé an d x"))
    assert len(word_hashes(None)) == len(word_hashes(" .,\n")) == 0
    long = "ab cde " * 300_000 + "z" * 3_000_000 + " ab"
    got = word_hashes(long)
    assert len(got) == 600_002 and len(set(got.tolist())) == 3 and got[0] == got[-1]
    assert len(shingles(a, 5)) == 3 and len(shingles(a[:2], 5)) == 1 and len(shingles(a[:0], 5)) == 0


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa. lambda mu nu xi omicron pi rho sigma tau upsilon"
HALVES = [ITEM[: ITEM.index(" lambda")], ITEM[ITEM.index("lambda") :]]


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_planted(spark, limit):
    docs = [
        (1, f"before {ITEM} after"), (2, f"{HALVES[1]} in between, {HALVES[0].upper()}!"), (3, "alpha beta gamma delta one two"),
        (4, "clean text " * 50), (5, None), (6, ""), (7, "filler " * 100_000 + ITEM), (8, "tiny item"), (1, f"before {ITEM} after"), (None, ITEM),
    ]
    bench = [(10, ITEM), (11, None), (12, ""), (13, "tiny item"), (14, "never seen words at all here"), (10, "another text with the same key")]
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, coverage double").repartition(3)
    b = spark.createDataFrame([(*x, "z") for x in bench], "item_id int, text string, doc_id string")
    got = find_contamination(df, b, limit=limit).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 10), (1, 10), (1, 10), (2, 10), (7, 10), (8, 13)]
    assert all(r.coverage == 1.0 for r in got) and {len(r.tiles) for r in got if r.doc_id == 2} == {2}
    kept = decontaminated(df, b, limit=limit)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == df.columns
    for empty in (find_contamination(df.limit(0), b), find_contamination(df, b.limit(0)), decontaminated(df.limit(0), b)):
        assert empty.count() == 0
    assert decontaminated(df, b.limit(0)).count() == len(docs)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    con = database(sf)
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    docs = [(k, words(t)) for k, t in con.execute("select doc_id, text from documents where length(text) < 3000").fetchall()]
    items = [(k, words(t)) for k, t in con.execute("select item_id, text from benchmark").fetchall()]
    want = set()
    for d, t in docs:
        runs = {tuple(t[i : i + 5]) for i in range(len(t) - 4)}
        for k, w in items:
            if any(tuple(w[i : i + 5]) in runs for i in range(len(w) - 4)) and (n := brute(t, w, 5)) >= 0.5 * len(w):
                want.add((d, k, round(n / len(w), 9)))
    kept = {d for d, _ in docs}
    got = {(r.doc_id, r.item_id, round(r.coverage, 9)) for r in decontaminate.op8_decontaminate(spark, sf).collect() if r.doc_id in kept}
    assert got == want and want
