"""Language and quality: held-out accuracy, the folded model against the kernel itself, odd rows."""

import numpy as np
import pytest

from skywell.llm import langid, quality
from skywell.llm.langid import Grams, SIZES, STARTS, identify_languages, kernel, learn_language_model, sizes_of
from tests.compare import database

SF = "/root/testdata/sf0.1"


def test_language_of_held_out_rows(spark):
    truth = dict(database(SF).execute("select doc_id, lang from documents").fetchall())
    got = [r for r in langid.op4_langid(spark, SF).collect()]
    assert len(got) == len(truth) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_folded_weights_equal_the_kernel():
    r = np.random.default_rng(1)
    letters = [ord(c) for c in " abcdefgé"]
    make = Grams(letters)
    texts = ["".join(r.choice(list("abc " if i % 2 else "cdé g"), 30)) for i in range(60)]
    grams = [make(t) for t in texts]
    model = langid.fit(letters, ["x" if i % 2 else "y" for i in range(60)], grams, 20, 1e-4)
    plain = np.array([[sum(len(set(a[(a >= lo) & (a < hi)]) & set(b)) / np.sqrt(sizes_of(a)[p] * sizes_of(b)[p])
                           for p, (lo, hi) in enumerate(zip(STARTS, STARTS[1:]))) for b in grams[:5]] for a in grams])
    np.testing.assert_allclose(kernel(grams, grams[:5]), plain, rtol=1e-6)
    assert len(SIZES) == 3 and (model.scores(grams).argmax(axis=1) == [1 - i % 2 for i in range(60)]).all()


def test_language_rows(spark):
    rows = [(i, w * 8, lang) for i in range(30) for w, lang in (("the cat and this ", "en"), ("der und nicht ein ", "de"))]
    odd = [(100, None, "en"), (101, "", "de"), (102, "123 ?", None), (103, "der und ein " * 50_000, None), (103, "THE CAT", None), (None, "nicht ein", "de")]
    df = spark.createDataFrame([(*r, 0) for r in rows + odd], "doc_id long, text string, lang string, lang_pred int").repartition(4)
    model = learn_language_model(df)
    got = identify_languages(df, model).collect()
    by = {(r.doc_id, r.lang_pred) for r in got}
    assert len(got) == len(rows + odd)
    assert {(100, "und"), (101, "und"), (102, "und"), (103, "de"), (103, "en"), (None, "de")} <= by
    none = learn_language_model(df.limit(0))
    assert {r.lang_pred for r in identify_languages(df, none).collect()} == {"und"}
    assert identify_languages(df.limit(0), model).count() == 0


def test_quality_of_held_out_rows(spark):
    truth = dict(database(SF).execute("select doc_id, quality from labels").fetchall())
    got = quality.op9_quality(spark, SF).collect()
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97


@pytest.mark.parametrize("prior", [0.2, 0.7])
def test_prior_and_risk_on_a_mixture(prior):
    r = np.random.default_rng(3)
    positive = r.normal(1.5, 1, (1500, 4))
    truth = r.random(4000) < prior
    unlabelled = np.where(truth[:, None], r.normal(1.5, 1, (4000, 4)), r.normal(-1.5, 1, (4000, 4)))
    model = quality.fit_non_negative(positive, unlabelled)
    assert model.prior == pytest.approx(prior, abs=0.08)
    assert ((model.scores(unlabelled) >= 0.5) == truth).mean() > 0.95


def test_quality_rows(spark):
    docs = [(i, "plain words in a line. " * 20 if i % 2 else "JUNK!! $$$ ### " * 30) for i in range(200)]
    docs += [(300, None), (301, ""), (302, "long words here. " * 60_000), (302, "again"), (None, "x")]
    df = spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, score string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 200, 3)] + [(1, 0, 0), (1, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(df, quality.learn_quality(df, labels)).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    mean = lambda odd: np.mean([r.score for r in got if r.doc_id is not None and r.doc_id < 200 and r.doc_id % 2 == odd])
    assert mean(1) > mean(0)
    unlearnt = quality.learn_quality(df, labels.limit(0))
    assert {r.score for r in quality.score_quality(df, unlearnt).collect()} == {0.5}
    assert quality.score_quality(df.limit(0), unlearnt).count() == 0


def test_small_languages_of_other_scripts(spark):
    """A frequent language with many letters leaves none of the others' characters out."""
    r = np.random.default_rng(3)

    def words(letters, n):
        return " ".join("".join(r.choice(letters, 5)) for _ in range(n))

    scripts = {"xx": [chr(0x100 + 2 * i + 1) for i in range(60)] + list("abcdefgh"), "el": list("αβγδεζηθικλμνξ"), "he": list("אבגדהוזחטיכלמנ"), "th": list("กขคงจฉชซ")}
    rows = [(i, lang, words(scripts[lang], 200 if lang == "xx" else 4)) for lang in scripts for i in range(40)]
    df = spark.createDataFrame([(1000 * k + i, t, lang) for k, (i, lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = learn_language_model(df.filter("doc_id % 1000 < 30"))
    truth = {1000 * k + i: lang for k, (i, lang, _) in enumerate(rows)}
    got = {x.doc_id: x.lang_pred for x in identify_languages(df, model).collect()}
    assert got == truth
