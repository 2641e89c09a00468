"""Periodic runs: all runs against a scan of every lag, and the query against plain code."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

from skywell.llm import periodic
from skywell.llm.periodic import find_runs, op13_runs, periodic_runs
from tests.compare import database


def brute(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(r):
    letters, words = r.choice([1, 2, 3, 5, 50]), []
    while len(words) < r.choice([5, 20, 60, 150]):
        if r.random() < 0.5:
            part = [r.randrange(letters) for _ in range(r.randint(1, 8))] * r.randint(1, 7)
            words += part[: r.randint(1, len(part))]
        else:
            words.append(r.randrange(letters))
    return [str(w) for w in words]


def test_runs_equal_brute_force():
    r = random.Random(5)
    for _ in range(1500):
        words = some_words(r)
        assert periodic_runs(words) == brute(words), words


def test_segments_hold_frequent_words_only():
    import numpy as np

    r = random.Random(6)
    for _ in range(300):
        ids = np.array([int(r.random() ** 3 * 30) for _ in range(r.randint(0, 200))])
        for lo, hi in periodic.segments(ids):
            part = ids[lo:hi].tolist()
            assert hi - lo >= 6 and all(part.count(w) >= 4 for w in part)


def test_long_texts_take_no_square_of_time():
    started = time.time()
    assert periodic_runs([str(i % 7) for i in range(200_000)]) == [(0, 200_000, 7)]
    assert periodic_runs([str(i % 999) for i in range(20_000)]) == [(0, 20_000, 999)]
    deep = [x for i in range(30_000) for x in (str(i), str(i), str(i), str(i + 1))]  # splits by one word after another
    assert periodic_runs(deep) == []
    assert time.time() - started < 20


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b " * 4), (4, "a b " * 4), (None, "x" * 9 + " x" * 6), (5, "a b " * 6), (6, "a b c")]
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, runs int").repartition(2)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed) for r in find_runs(df).collect()), key=repr)
    assert got == sorted([
        (1, 0, [], None, ""), (2, 0, [], None, ""), (3, 0, [], None, ""), (4, 8, [(0, 8, 2)], (0, 8, 2), "a b"), (4, 8, [(0, 8, 2)], (0, 8, 2), "a b"),
        (None, 7, [(1, 6, 1)], (1, 6, 1), "x" * 9 + " x"), (5, 6, [(0, 6, 1)], (0, 6, 1), "a b"), (6, 3, [], None, "a b c"),
    ], key=repr)
    assert find_runs(df.limit(0)).count() == 0
    assert find_runs(df.select(df.doc_id.alias("best"), df.text.alias("n_words")), "n_words", "best").columns[0] == "best"


def test_query_equals_plain_code(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op13_runs(spark, sf).collect()}
    docs = database(sf).execute("select doc_id, text from documents").fetchall()
    assert len(got) == len(docs)
    long = 0
    for k, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(k).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 700:  # the plain scan of all lags takes the square of the length
            long += 1
            continue
        runs = brute(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        left = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
        r = got[k]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(left).encode()).hexdigest()
    assert long < len(docs) / 6
