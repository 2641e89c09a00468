"""Phrases: the query against SQL, small corpora against plain counts, long texts in parts, odd rows."""

import random
import re
from collections import Counter

import pytest

from skywell.llm import phrases
from skywell.llm.phrases import Block, collocations, parts, phrase_counts
from tests.compare import database, difference


def plain_counts(rows, longest=3):
    out = {n: Counter() for n in range(1, longest + 1)}
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            for n in out:
                out[n].update((lang or "und", " ".join(words[i : i + n])) for i in range(len(words) - n + 1))
    return out


def plain_collocations(rows, least, top):
    f = plain_counts(rows)
    total = Counter()
    for (lang, _), c in f[1].items():
        total[lang] += c
    found = []
    for n in (2, 3):
        for (lang, phrase), a in f[n].items():
            if a < least:
                continue
            words = phrase.split(" ")
            cuts = []
            for k in range(1, n):
                l, r = f[k][lang, " ".join(words[:k])], f[n - k][lang, " ".join(words[k:])]
                cuts.append((1000000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            if not any(f" {phrase} " in f" {p} " and x == lang and 100 * c >= 50 * a for (x, p), c in f[3].items() if n == 2 and c >= least):
                found.append((lang, phrase, a, l, r, total[lang], score))
    out = []
    for lang in total:
        mine = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(lang, i + 1, *x[1:]) for i, x in enumerate(mine[:top])]
    return sorted(out)


def corpus(r, n):
    vocabulary = ["Alpha", "beta", "GAMMA", "über", "δ", "e-f", "a b", *(f"w{i}" for i in range(40))]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(r.randint(0, 60)):
            text += r.choice(["new york city", "in spite of", r.choice(vocabulary), vocabulary[int(r.random() ** 2 * 10)]]) + r.choice([" "] * 6 + ["\t ", ". ", "\n", ",x;"])
        rows.append((r.choice(["en", "en", "en", "fr", None]), text))
    return rows


@pytest.mark.parametrize("shards, block, least", [(1, 1 << 20, 3), (3, 400, 10), (4, 1 << 20, 2)])
def test_small_corpora_equal_plain_counts(spark, shards, block, least):
    rows = corpus(random.Random(shards), 250) + [(None, None), ("en", ""), ("und", "a b a b a b a b a b a b"), ("en", "same row x") , ("en", "same row x")]
    df = spark.createDataFrame([(*x, 1) for x in rows], "lang string, text string, score int").repartition(3)
    got = sorted(tuple(r) for r in collocations(df, least=least, top=25, shards=shards, block=block).collect())
    assert got == plain_collocations(rows, least, 25)
    want = plain_counts(rows)
    for n, t in enumerate(phrase_counts(df, least=least, shards=shards, block=block), 1):
        assert {(r.lang, r.phrase): r.c for r in t.collect()} == {k: c for k, c in want[n].items() if n == 1 or c >= least}


def test_full_bit_sets_only_cost_rows(spark, monkeypatch):
    """With sets so small that they hold everything, each phrase still counts for its own cycle."""
    monkeypatch.setattr(phrases, "may_hold", lambda held, h: h == h)
    rows = corpus(random.Random(9), 150)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert sorted(tuple(r) for r in collocations(df, least=5, top=50).collect()) == plain_collocations(rows, 5, 50)


def test_parts_of_a_long_text_count_like_the_whole():
    import numpy as np
    import pyarrow as pa

    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choice(["a", "bb", "c", " ", " ", " ", "\t", ".", "lOng" * r.randint(1, 9)] if r.random() < 0.9 else ["."]) for _ in range(r.randint(0, 300)))
        if r.random() < 0.5:
            text = text.replace(".", " ")
        pieces = list(parts(text.encode(), r.choice([5, 20, 60])))
        block = Block(pa.array([p for p, _ in pieces], pa.binary()), pa.array([b"en"] * len(pieces), pa.binary()), np.array([w for _, w in pieces], np.int64))
        full = np.full(1 << 13, 255, np.uint8)
        got = Counter()
        for batch in block.counted(True, {2: [full], 3: [full]}, 0, 1):
            for x in batch.to_pylist():
                got[x["n_words"], x["phrase"]] += x["c"]
        assert +got == Counter({(n, p): c for n, counts in plain_counts([("en", text)]).items() for (_, p), c in counts.items()})


def test_no_rows(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations(empty).count() == 0
    assert [t.count() for t in phrase_counts(empty)] == [0, 0, 0]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert difference(phrases.op11_phrases(spark, sf), database(sf), phrases.SQL_WORDS) is None
