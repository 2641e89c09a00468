"""Near-duplicates: classes against a brute-force comparison, planted copies, hot buckets, odd rows."""

import random
from collections import defaultdict

import numpy as np
import pytest

from skywell.llm import neardup
from skywell.llm.common import shingles, word_hashes
from skywell.llm.components import components
from skywell.llm.neardup import SIMILARITY, WORDS, chain, deduplicated, labelled, near_duplicates
from tests.compare import database


def brute_classes(texts: dict) -> dict:
    """The least key of each key's class: all pairs that share one of the rarest shingles are aligned."""
    seqs = {k: labelled(shingles(word_hashes(t), WORDS)) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    where = defaultdict(list)
    for k in sorted(texts):
        s = seqs[k]
        prefix = np.sort(s)[: len(s) - int(np.ceil(SIMILARITY * len(s) - 1e-9)) + 1].tolist()
        for other in {o for x in prefix for o in where[x]}:
            n = chain(s, seqs[other])
            if n / max(len(s) + len(seqs[other]) - n, 1) >= SIMILARITY:
                a, b = sorted((root(k), root(other)))
                parent[b] = a
        for x in prefix:
            where[x].append(k)
    return {k: root(k) for k in texts}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(database(sf).execute("select doc_id, text from documents").fetchall())
    got = {r.doc_id: r.class_id for r in neardup.op6_neardup(spark, sf).collect()}
    want = brute_classes(texts)
    assert len(set(want.values())) < len(want) and got == want


def longest(a, b):
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + (x == y))
    return table[-1, -1]


def test_chain_equals_the_full_alignment():
    r = random.Random(4)
    for _ in range(150):
        a = [r.randrange(12) for _ in range(r.randint(1, 40))]
        b = [x for x in a if r.random() > 0.08]
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(b) + 1)
            b[i:i] = [r.randrange(12)]
        if r.random() < 0.3:
            b = b[len(b) // 2 :] + b[: len(b) // 2]
        x, y = (labelled(np.array(s, np.uint64)) for s in (a, b))
        n, want = chain(x, y), longest(x.tolist(), y.tolist())
        similar = want / (len(x) + len(y) - want) >= SIMILARITY
        assert (n / (len(x) + len(y) - n) >= SIMILARITY) == similar
        assert not similar or n == want


def test_signatures_keep_text_order():
    words = word_hashes("a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9")
    same = neardup.signatures(words)
    assert np.array_equal(same, neardup.signatures(words.copy()))
    halves = np.concatenate((words[18:], words[:18]))
    assert (neardup.signatures(halves) == same).mean() < 0.5
    long = np.random.default_rng(0).integers(0, 50_000, 60_000).astype(np.uint64)
    whole = labelled(shingles(long, WORDS))
    order = neardup.ORDERS[:1]
    best = np.sort(np.argsort(whole * order[0])[:4])
    out = order.copy()
    for i in best:
        out = neardup.mixed(out * np.uint64(0xD6E8FEB86659FD93) + whole[i])
    assert neardup.least_in_order(whole, order, 4)[0] == out[0]


def story(r, n):
    return [f"{r.choice('abcdefghij')}{r.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark):
    """A hot group of copies, one of near copies, a passage in many texts, short and odd texts."""
    r = random.Random(7)
    copy, base, passage = story(r, 80), story(r, 150), story(r, 120)
    rows = [(i, " ".join(copy)) for i in range(300)]
    for i in range(300, 600):
        words = list(base)
        for _ in range(2):
            words[r.randrange(len(words))] = f"new{r.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(passage + story(r, 90))) for i in range(600, 900)]  # more than half is shared
    rows += [(i, " ".join(story(r, 60))) for i in range(900, 1000)]
    rows += [(1000, "one two three"), (1001, "One, two THREE!"), (1002, "one two four"), (1003, None), (1004, None), (1005, ""), (1006, " .")]
    rows += [(1007, " ".join(base[75:] + base[:75])), (None, " ".join(copy)), (5, " ".join(copy))]
    long = story(r, 70_000)
    rows += [(1008, " ".join(long)), (1009, " ".join(long[:-30] + story(r, 30)))]
    return rows, spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, class_id string").repartition(7)


def test_planted(planted):
    rows, df = planted
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = defaultdict(set)
    for x in got:
        by[x.doc_id].add((x.class_id, x.class_size))
    assert by[None] == by[0] == by[5] == {(0, 302)}
    texts = {k: t for k, t in rows if k is not None and t and k < 1003 or k in (1007, 1008, 1009)}
    want = brute_classes(texts)
    assert {k: next(iter(by[k]))[0] for k in texts} == want
    assert want[1001] == 1000 and want[1009] == 1008 and want[1007] == 1007 and want[599] == 300
    assert all(by[k] == {(k, 1)} for k in (1003, 1004, 1005, 1006))


def test_one_of_each_class_stays(planted):
    rows, df = planted
    kept = deduplicated(df)
    assert kept.columns == df.columns
    got = sorted(r.doc_id for r in kept.collect())
    assert got == sorted({0, 300, 1000, 1002, 1003, 1004, 1005, 1006, 1007, 1008, *range(600, 1000)})
    assert deduplicated(df.limit(0)).count() == near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    r = random.Random(3)
    names = list(range(400))
    r.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(199)] + [(names[200], x) for x in names[201:390]] + [(names[395], names[395])]
    got = {x.node: x.label for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{x: min(names[:200]) for x in names[:200]}, **{x: min(names[200:390]) for x in names[200:390]}}


def test_planted_pairs_in_a_crowd_below_the_threshold(spark):
    """Texts of one template are under 0.8 from one another, the planted pairs above; members that never lead are compared too."""
    r = random.Random(12)
    template = [f"t{i}" for i in range(180)]
    rows, partner = [], {}
    for i in range(300):
        own = [f"u{i}x{k}" for k in range(30)]
        rows.append((i, " ".join(template + own)))  # crowd: 176 of 236 shingles, 0.746
        if i < 40:
            changed = own[:6] + [f"v{i}x{k}" for k in range(24)]  # 182 of 230 shingles with the crowd's text, 0.79
            near = own[:14] + [f"w{i}x{k}" for k in range(16)]  # 190 of 222, 0.856
            rows += [(1000 + i, " ".join(template + changed)), (2000 + i, " ".join(template + near))]
            partner[i] = 2000 + i
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.class_id for x in near_duplicates(df).collect()}
    want = brute_classes(dict(rows))
    assert all(want[i] == want[j] for i, j in partner.items()) and len(set(want.values())) == len(rows) - len(partner)
    assert got == want
