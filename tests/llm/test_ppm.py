"""Scores against plain counts and a plain trie, held-out rows against words, odd rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skywell.llm import ppm
from skywell.llm.ppm import ORDER, Places, score_documents
from tests.compare import database


def lower(text):
    return (text or "").encode().lower()


def plain_model(texts):
    """Counts by context: of all positions for the longest, of the longer contexts for the others."""
    tries = [defaultdict(Counter) for _ in range(ORDER + 1)]
    for t in texts:
        s = [None] * ORDER + list(lower(t)) + ["end"]
        for i in range(ORDER, len(s)):
            tries[ORDER][tuple(s[i - ORDER : i])][s[i]] += 1
    for k in range(ORDER, 0, -1):
        for context, seen in tries[k].items():
            for x in seen:
                tries[k - 1][context[1:]][x] += 1
    return tries


def plain_score(tries, text):
    s = [None] * ORDER + list(lower(text)) + ["end"]
    total = 0.0
    for i in range(ORDER, len(s)):
        excluded = set()
        for k in range(ORDER, -1, -1):
            seen = tries[k].get(tuple(s[i - k : i]))
            if not seen:
                continue
            left = {x: c for x, c in seen.items() if x not in excluded}
            whole = 2 * sum(left.values())
            if not whole:
                continue
            if s[i] in left:
                total += math.log10((2 * left[s[i]] - 1) / whole)
                break
            total += math.log10(len(left) / whole)
            excluded |= set(left)
        else:
            total += math.log10(1 / (257 - len(excluded)))
    return total


def check(rows, texts, held):
    """`texts`: key, text pairs; `rows`: the scores."""
    train = [t for k, t in texts if not held(k)]
    trie = plain_model(train)
    tokens = Counter(w for t in train for w in lower(t).split()) + Counter({b"\n": len(train)})
    n, v = sum(tokens.values()), len(tokens)
    by = defaultdict(list)
    for k, t in texts:
        words = [*lower(t).split(), b"\n"]
        base = sum(math.log10((tokens[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        by[k].append((held(k), len(words), sum(tokens[w] > 0 for w in words), n, base, plain_score(trie, t)))
    assert len(rows) == len(texts)
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    for k in by:
        for a, b in zip(sorted(by[k]), sorted(got[k])):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def held_by_crc(k):
    return k is not None and zlib.crc32(str(k).encode()) % 5 == 1


@pytest.mark.parametrize("block", [1 << 25, 60])
def test_small_documents_equal_a_plain_trie(spark, block):
    r = random.Random(8)
    texts = [(i, "".join(r.choice("abAB \nÉ\x1c ") for _ in range(r.randint(0, 40)))) for i in range(40)]
    texts += [(40, None), (41, ""), (42, "zzz never seen \x00"), (3, "twice twice"), (3, "twice twice"), (None, "no key")]
    df = spark.createDataFrame([(*x, 1.0) for x in texts], "doc_id long, text string, score double").repartition(3)
    check(score_documents(df, ppm.held_out("doc_id", 5, 1), block=block).collect(), texts, held_by_crc)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in score_documents(df, F.lit(True)).collect()}
    assert got[1].score == pytest.approx(3 * math.log10(1 / 257)) and got[2].n_known == 0 and got[1].train_tokens == 0
    assert got[1].base_score == pytest.approx(0.0)
    assert score_documents(df.limit(0), F.lit(True)).count() == 0


def test_query_equals_plain_counts(spark):
    sf = "/root/testdata/sf0.001"
    rows = ppm.op1_ppm(spark, sf).collect()
    texts = database(sf).execute("select doc_id, text from documents").fetchall()
    check(rows, texts, held_by_crc)


def test_beats_words_on_held_out_rows(spark):
    held = ppm.op1_ppm(spark, "/root/testdata/sf0.1").filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held.s > 0.98 * held.b


def test_places():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 45, 5000))
    np.random.default_rng(1).shuffle(keys)
    places = Places(keys)
    at = np.random.default_rng(2).integers(0, len(keys), 20000)
    assert np.array_equal(places(keys[at]), at)


def test_runs_of_slices():
    texts = ppm.lowered(pa.array(["ab", None, "", "xyz", "a"]))
    codes, sizes = ppm.runs_of(texts)
    again, less = ppm.runs_of(texts.slice(3, 2))
    assert sizes.tolist() == [3, 1, 1, 4, 2] and np.array_equal(codes[5:], again) and less.tolist() == [4, 2]
    assert codes[0] == ord("a") + 1 and codes[3] == codes[4] == ppm.END
