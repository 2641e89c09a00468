"""The pipeline: its rows against the stages done by brute force, and odd rows stage by stage."""

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from skywell.llm import secrets
from skywell.llm.decontaminate import Items
from skywell.llm.common import word_hashes
from tests.compare import database
from tests.llm.test_neardup import brute_classes
from tests.llm.test_packing import check


def redacted(text):
    parts, last = [], 0
    for s, _, e in sorted(secrets.Unwrapping(text).spans):
        if s > last or not parts:
            parts += [text[last:s], "[secret]"]
        last = max(last, e)
    return "".join(parts) + text[last:]


def test_run_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    con = database(sf)
    texts = {k: t for k, t in con.execute("select doc_id, text from documents").fetchall() if t and any(map(str.isalpha, t))}
    texts = {k: texts[k] for k, c in brute_classes(texts).items() if k == c}
    bench = [word_hashes(t) for t, in con.execute("select text from benchmark").fetchall()]
    known = Items(list(range(len(bench))), bench, 5)
    texts = {k: t for k, t in texts.items() if all(n < 0.5 * len(bench[i]) for i, n, _ in known.covered(word_hashes(t)))}
    check(corpus_pipeline.run(spark, sf).collect(), {k: [redacted(t)] for k, t in texts.items()}, 2048)


def test_stages_on_odd_rows(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, "en"), (2, "", None), (3, "12 !?", "en"), (4, words, "en"), (5, words, "en"), (4, words, "en"), (None, words, None),
            (6, f"ein anderer Text mit token={'k' * 20} darin", "de"), (7, "y" * 200_000 + " ende", "de")]
    df = spark.createDataFrame([(*r, "s", 5, "x", 0.5, 1) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, lang_pred string, score double, size int").repartition(3)
    for docs, kept in ((df, [4, 6, 7]), (df.limit(0), [])):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == df.columns, name
            docs = out
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == kept
        assert {r.text for r in docs.filter("doc_id = 6").collect()} == ({"ein anderer Text mit [secret] darin"} if kept else set())
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
        assert sorted({r.doc_id for r in pieces.collect()}) == kept


def test_queries_are_registered():
    names = set(queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
