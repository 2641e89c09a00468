"""Url rules against SQL, ranks against a matrix walk, odd rows."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from skywell.llm import linkrank
from skywell.llm.linkrank import RULES, RankSettings, judge_urls
from tests.compare import database

SF = "/root/testdata/sf0.01"


def test_query_rules_equal_sql(spark):
    cases = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}'"
        for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    )
    want = {r[0]: r[1:] for r in database(SF).execute(
        r"WITH u AS (SELECT page_id, lower(regexp_extract(url, '^.*?://([^/?#]*)', 1)) AS host, "
        rf"regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages) SELECT page_id, host, path, CASE {cases} END FROM u"
    ).fetchall()}
    got = linkrank.op10_linkrank(spark, SF).collect()
    assert {r.page_id: (r.host, r.path, r.rule) for r in got} == want and len(got) == len(want)
    verdicts = {h + p: v for v, h, p in RULES}
    assert all(r.verdict == verdicts[r.rule] for r in got if r.rule)


def walk(pages, settings):
    """The three ranks of every host by dense matrix steps."""
    seeds, edges = {k: Counter() for k in ("own", "trust", "distrust")}, Counter()
    hosts = set()
    for host, rule, targets in pages:
        seeds["own"][host] += 1
        if rule:
            seeds["trust" if rule == "allow" else "distrust"][host] += 1
        for t in targets:
            edges[host, t] += 1.0
            hosts.add(t)
        hosts.add(host)
    for h in list(hosts):
        parent = h.partition(".")[2]
        if "." in parent:
            hosts.add(parent)
            edges[h, parent] += 1.0
            edges[parent, h] += 1.0
    names = sorted(hosts)
    m = np.array([[edges[a, b] for b in names] for a in names])
    out = {}
    for kind, way in (("own", m), ("trust", m), ("distrust", m.T)):
        share = way / np.maximum(way.sum(axis=1, keepdims=True), 1e-300)
        seed = np.array([seeds[kind][h] for h in names], float)
        x = seed
        for _ in range(300):  # until nothing moves
            x = (1 - settings.damping) * seed + settings.damping * (x @ share)
        out[kind] = dict(zip(names, x))
    return out


def test_ranks_equal_a_matrix_walk(spark):
    r = np.random.default_rng(2)
    hosts = [f"h{i}.org" for i in range(8)] + ["good.com", "a.bad.net", "b.bad.net", "sub.h1.org"]
    pages, rows = [], []
    for i in range(120):
        host = hosts[0] if i % 3 == 0 else hosts[r.integers(len(hosts))]
        targets = [t for t in {hosts[j] for j in r.integers(len(hosts), size=3)} if t != host]
        path = "/es/x" if i % 2 else "/x"
        rule = "allow" if host.endswith(".com") else "block" if host.endswith(".net") and path == "/es/x" else None
        pages.append((host, rule, targets))
        links = "".join(f"<a href='https://{t.upper()}/q?x=http://no.org/'>t</a>" for t in targets)
        rows.append((i, f"http://{host}{path}?q#f", f"{links}<a href=/rel>r</a><a href=//{host}/self>s</a>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    settings = RankSettings(tolerance=1e-6)
    want = walk(pages, settings)
    got = judge_urls(df, settings=settings).collect()
    assert len(got) == 120
    for row in got:
        for kind in ("own", "trust", "distrust"):
            np.testing.assert_allclose(row[kind], want[kind][row.host], atol=1e-6 * 120)
        if row.rule is None:
            bad = row.distrust - row.trust >= 0.5 * row.own
            assert row.verdict == ("block" if bad else "allow")


def test_who_links_to_blocked_hosts_is_blocked(spark):
    farm = [(i, f"http://farm.org/{i}", "<a href='http://x.net/es/1'>x</a>") for i in range(3)]
    fine = [(10, "http://fine.org/", "<a href='http://y.com/'>y</a>"), (12, "http://y.com/", "")]
    fine += [(11, "http://x.net/es/1", "")] * 20
    got = {r.page_id: r.verdict for r in judge_urls(spark.createDataFrame(farm + fine, "page_id long, url string, html string")).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 10: "allow", 11: "block", 12: "allow"}


def test_rank_reaches_the_end_of_a_long_chain(spark):
    chain = [(i, "http://www.example.com/en/" if i == 0 else f"http://h{i}.org/", f"<a href='http://h{i + 1}.org/'>x</a>") for i in range(25)]
    got = {r.page_id: r.trust for r in judge_urls(spark.createDataFrame(chain, "page_id long, url string, html string")).collect()}
    np.testing.assert_allclose([got[i] / got[i - 1] for i in range(2, 25)], 0.85, rtol=1e-2)


def test_rows(spark):
    rows = [(1, None, "x"), (2, "no scheme", None), (3, "HTTP://WWW.Example.COM", None), (4, "a://b://c/d", ""), (5, "http://x.com?y/", ""),
            (6, "https://www.example.com/en/?q", ""), (6, "https://www.example.com/en/?q", ""), (None, "://net/es/", ""), (8, "x://É.NET/fr/" + "a" * 99_999, "")]
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, own int").repartition(2)
    got = judge_urls(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert by[1] == by[2] == ("", "", None, "allow")
    assert by[3] == ("www.example.com", "", None, by[3][3]) and by[4][:2] == ("b:", "//c/d") and by[5][:3] == ("x.com", "", None)
    assert by[6] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert by[None] == ("net", "/es/", "net/es/", "block") and by[8][0] == "É.net" and by[8][2] == "net/fr/"
    assert judge_urls(df.limit(0)).count() == 0
    assert judge_urls(df.withColumn("page_id", F.col("page_id").cast("string"))).count() == len(rows)
