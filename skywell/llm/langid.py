"""Language identification with a string kernel.

A text is the set of its distinct character n-grams of each length 1..3 (a blended spectrum). The
kernel of two texts is the sum over lengths of `shared / sqrt(distinct * distinct)`. Nyström
landmarks stand for the sample; one-versus-rest kernel ridge regression is fitted on them. As the
kernel against a landmark is a product with that landmark's 0/1 vector, all landmarks and their
weights fold into one matrix (n-gram x language) per length, so scoring a batch is one sparse
product per length and no landmark is visited per text.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skywell.llm.common import fresh, held_out, mapped, query, sampled, small_batches, table, written

UNDETERMINED = "und"
BITS = 21  # of a code point plus one, so codes of longer n-grams are larger
SIZES = (1, 2, 3)
STARTS = np.array([0, 1 << BITS, 1 << 2 * BITS, (1 << 3 * BITS) - 1], np.int64)
COLUMNS = 1 << 13  # n-grams of a dense block


def points(text: str) -> np.ndarray:
    """Code points of the lower-case text, blanks collapsed, one blank at either end."""
    flat = f" {' '.join(text.lower().split())} "
    return np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)


class Grams:
    """Distinct n-grams of texts as increasing codes; all characters, or `letters` alone with the others as one, are told apart."""

    def __init__(self, letters: list[int] | None = None):
        self.letters = None if letters is None else np.unique(np.array(letters, np.int64))

    def __call__(self, text: str) -> np.ndarray:
        ids = points(text).astype(np.int64)
        if self.letters is not None:
            ids[~np.isin(ids, self.letters)] = -1
        ids += 1 + (self.letters is not None)
        two = (ids[:-1] << BITS) | ids[1:]
        three = (two[:-1] << BITS) | ids[2:]
        return np.unique(np.concatenate((ids, two, three)))


def sizes_of(codes: np.ndarray) -> np.ndarray:
    """Distinct n-grams of each length, at least 1."""
    return np.maximum(np.diff(np.searchsorted(codes, STARTS)), 1).astype(float)


@dataclass
class LanguageModel:
    letters: list[int] | None
    languages: list[str]
    codes: np.ndarray  # of the landmarks' n-grams, increasing
    weights: np.ndarray  # n-gram x language
    bias: np.ndarray
    sharpness: float

    def scores(self, grams: list[np.ndarray]) -> np.ndarray:
        """Probability-like scores, text x language, for a batch of n-gram sets."""
        out = np.tile(self.bias, (len(grams), 1))
        if not grams:
            return out
        codes = np.concatenate(grams)
        which = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        sizes = np.stack([sizes_of(g) for g in grams])
        scale = 1.0 / np.sqrt(sizes)[which, np.searchsorted(STARTS, codes, "right") - 1]
        at = np.searchsorted(self.codes, codes)
        known = at < len(self.codes)
        known[known] = self.codes[at[known]] == codes[known]
        at, which, scale = at[known], which[known], scale[known]
        for j in range(out.shape[1]):  # a sparse product, a language at a time
            out[:, j] += np.bincount(which, self.weights[at, j] * scale, len(grams))
        e = np.exp(self.sharpness * (out - out.max(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)


def kernel(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The blended presence kernel between two lists of n-gram sets, as matrix products."""
    used = np.unique(np.concatenate(b)) if b else np.zeros(0, np.int64)

    def dense(sets, keep):
        m = np.zeros((len(sets), len(keep)), np.float32)
        for i, g in enumerate(sets):
            at = np.searchsorted(keep, g)
            ok = at < len(keep)
            ok[ok] = keep[at[ok]] == g[ok]
            m[i, at[ok]] = 1
        return m

    sa, sb = (np.stack([sizes_of(g) for g in s]) for s in (a, b))
    out = np.zeros((len(a), len(b)))
    for p in range(len(SIZES)):
        keep = used[(used >= STARTS[p]) & (used < STARTS[p + 1])]
        blocks = [keep[i : i + COLUMNS] for i in range(0, len(keep), COLUMNS)]
        out += sum(dense(a, k) @ dense(b, k).T for k in blocks) / np.sqrt(np.outer(sa[:, p], sb[:, p]))
    return out


def fit(letters, languages: list[str], grams: list[np.ndarray], landmarks: int, ridge: float) -> LanguageModel:
    """Kernel ridge regression, one language against the rest, on evenly spread landmarks."""
    names = sorted(set(languages))
    if not names:
        return LanguageModel(letters, [], np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 1.0)
    y = np.array([[1.0 if x == n else 0.0 for n in names] for x in languages])
    by_language = [[i for i, x in enumerate(languages) if x == n] for n in names]
    chosen = [i for rows in by_language for i in rows[: max(1, landmarks // len(names))]]
    marks = [grams[i] for i in chosen]
    k_nm = kernel(grams, marks).astype(float)
    k_mm = k_nm[chosen]
    weight = 1.0 / (len(names) * y.sum(axis=0))[y.argmax(axis=1)]  # languages count alike
    bias = np.full(len(names), 1.0 / len(names))
    left = k_nm.T @ (k_nm * weight[:, None]) + ridge * k_mm + 1e-8 * np.eye(len(chosen))
    alpha = np.linalg.solve(left, k_nm.T @ ((y - bias) * weight[:, None]))
    codes = np.unique(np.concatenate(marks))
    folded = np.zeros((len(codes), len(names)))
    for g, a in zip(marks, alpha):
        scale = 1.0 / np.sqrt(sizes_of(g))
        folded[np.searchsorted(codes, g)] += scale[np.searchsorted(STARTS, g, "right") - 1][:, None] * a
    return LanguageModel(letters, names, codes, folded, bias, 8.0)


def learn_language_model(
    labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
    per_language: int = 600, landmarks: int = 256, ridge: float = 1e-4, seed: int = 4,
) -> LanguageModel:
    """Fit on about `per_language` rows of each language, chosen by a hash of the key.

    The sample bound is `per_language`; rows with a null text or language are not learnt from.
    Only n-gram sets (at most three numbers a character each) come to the driver, no texts. Without a
    labelled row the model knows no language and every text is undetermined.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.select(F.col(key).alias("k"), F.col(lang).alias("l"), F.col(text).alias("t")).filter(
        F.col("l").isNotNull() & F.col("t").isNotNull()
    )
    totals = {r.l: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    keep = F.lit(False)
    for name, n in sorted(totals.items()):
        keep = keep | ((F.col("l") == name) & sampled(F.col("k"), n, per_language, seed))
    chosen = written(rows.filter(keep))

    def sets(batches):
        grams = Grams()
        for b in batches:
            found = [grams(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("k").cast(pa.string()), b.column("l"), pa.array([g.tobytes() for g in found], pa.binary())],
                ["k", "l", "g"],
            )

    got = sorted((r.l, r.k or "", bytes(r.g)) for r in chosen.mapInArrow(sets, "k string, l string, g binary").collect())
    return fit(None, [r[0] for r in got], [np.frombuffer(r[2], np.int64) for r in got], landmarks, ridge)


def identify_languages(df: DataFrame, model: LanguageModel, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """Add `lang_pred` and `score` to the `keep` columns, one row per input row.

    Null texts and texts without a letter are `und` with score 0, as is everything under a model
    without languages; repeated rows repeat; other columns are not read. Where `keep` has one of the
    new names, the new column's gets a `_` before it.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # n-grams of the landmarks x languages

    def predict(texts):
        m = sent.value
        grams = Grams(m.letters)
        known = [bool(m.languages) and t is not None and any(map(str.isalpha, t)) for t in texts]
        p = m.scores([grams(t) for t, k in zip(texts, known) if k])
        best = iter(zip(p.argmax(axis=1), p.max(axis=1)) if len(p) else ())
        found = [next(best) if k else None for k in known]
        return [UNDETERMINED if f is None else m.languages[f[0]] for f in found], [0.0 if f is None else float(f[1]) for f in found]

    return mapped(df, text, keep, f"`{fresh('lang_pred', keep)}` string, `{fresh('score', keep)}` double", predict)


HELD = (5, 0)


@query()
def op4_langid(spark, sf_dir):
    """Predicted language of every document, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", *HELD))
    model = learn_language_model(docs.filter(~F.col("held_out")))
    return identify_languages(docs, model, keep=("doc_id", "held_out"))
