"""Text quality learnt from trusted positives and unlabelled text only.

A small network is trained with the non-negative risk estimator of positive-unlabelled learning:
with class prior p, the risk is `p * loss(positives as 1) + max(0, loss(unlabelled as 0) - p *
loss(positives as 0))`; where the second part falls below zero, the step goes against it. The
prior is estimated first: a classifier that tells positives from unlabelled text is read at the
threshold where the share of unlabelled rows beyond it, over that of positives, is least.
"""

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skywell.llm.common import fresh, held_out, mapped, query, sampled, small_batches, table

CLASSES = 9
OTHER_LETTER, SYMBOL = 7, 8


def character_classes() -> np.ndarray:
    """The class of each code point: other symbols, lower and upper case, digits, blanks, breaks, stops, dashes, letters."""
    of = np.full(0x110000, SYMBOL, np.uint8)
    of[0x80:] = OTHER_LETTER
    for c in range(0x250):
        s = chr(c)
        if s.isalpha():
            of[c] = 1 if s.isupper() else 0
        elif s.isdigit():
            of[c] = 2
        elif s in "\n\r":
            of[c] = 4
        elif s.isspace():
            of[c] = 3
        elif s in ".,;:":
            of[c] = 5
        elif s in "-'\"()?":
            of[c] = 6
        else:
            of[c] = SYMBOL
    return of


class Features:
    """How characters follow one another by class, and how much words and lines repeat."""

    size = CLASSES * CLASSES + 10

    def __init__(self):
        self.of = character_classes()

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        kinds = self.of[np.frombuffer(f"\n{text}\n".encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int16)
        pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
        words, lines = text.split(), text.split("\n")
        n = max(len(words), 1)
        counts = Counter(words)
        top = max(counts.values(), default=0)
        again = sum(map(str.__eq__, words[1:], words[:-1]))
        alpha = sum(map(str.isalpha, words))
        lettered = sum(map(str.islower, words))
        rest = [
            np.log1p(len(text)) / 10, np.log1p(len(words)) / 10, len(text) / n / 10, len(counts) / n,
            len(counts) / np.sqrt(n) / 10, top / n, again / n, alpha / n, lettered / n, len(set(lines)) / len(lines),
        ]
        return np.concatenate((np.sqrt(pairs / max(len(kinds) - 1, 1)), rest))


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    layers: list
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores in 0..1; the prior where nothing could be learnt."""
        if not self.layers:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(forward(self.layers, (x - self.mean) / self.scale)[-1], -30, 30)))


def forward(layers, x):
    """Hidden values and the output of a one-hidden-layer network."""
    w1, b1, w2, b2 = layers
    h = np.tanh(x @ w1 + b1)
    return h, (h @ w2 + b2)[:, 0]


def train(x, gradient, hidden: int, steps: int, rate: float, decay: float, seed: int):
    """Adam on `gradient(outputs) -> d risk / d output`, over all rows of `x` at every step."""
    r = np.random.default_rng(seed)
    layers = [r.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), r.normal(0, hidden**-0.5, (hidden, 1)), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for t in range(1, steps + 1):
        h, z = forward(layers, x)
        dz = gradient(z)[:, None]
        dh = (dz @ layers[2].T) * (1 - h * h)
        grads = [x.T @ dh + decay * layers[0], dh.sum(axis=0), h.T @ dz + decay * layers[2], dz.sum(axis=0)]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            layers[i] = layers[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return layers


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 16, steps: int = 200, seed: int = 9) -> float:
    """The share of positives in unlabelled rows, from a classifier's held-back halves.

    Over all thresholds, the least ratio of the unlabelled share above it to the positives' share
    above it, each with its sampling error; a mixture can't hold more positives than that.
    """
    halves = [(positive[i::2], unlabelled[i::2]) for i in (0, 1)]
    p, u = halves[0]
    x = np.concatenate((p, u))
    y = np.concatenate((np.ones(len(p)), np.zeros(len(u))))
    weight = np.concatenate((np.full(len(p), 0.5 / len(p)), np.full(len(u), 0.5 / len(u))))
    layers = train(x, lambda z: weight * (sigmoid(z) - y), hidden, steps, 0.01, 1e-4, seed)
    sp, su = (np.sort(forward(layers, s)[-1]) for s in halves[1])
    cuts = sp[:: max(1, len(sp) // 400)]
    above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    above_u = 1 - np.searchsorted(su, cuts) / len(su)
    error = np.sqrt(np.log(40) / 2) * (len(su) ** -0.5 + len(sp) ** -0.5)
    ok = above_p > 0.05
    best = np.argmin((above_u[ok] + error) / above_p[ok])
    return float(np.clip(above_u[ok][best] / above_p[ok][best], 0.01, 0.99))


def fit_non_negative(positive: np.ndarray, unlabelled: np.ndarray, hidden: int = 16, steps: int = 400, seed: int = 9) -> QualityModel:
    """The network that minimises the non-negative risk with the sigmoid loss."""
    if len(positive) < 4 or len(unlabelled) < 4:
        return QualityModel(np.zeros(0), np.ones(0), [], 0.5)
    both = np.concatenate((positive, unlabelled))
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    prior = estimate_prior(p, u)
    n = len(p)

    def gradient(z):
        s = sigmoid(z)
        slope = s * (1 - s)  # of the loss of being 0; its negative of the loss of being 1
        wp, wu = np.full(n, prior / n), np.full(len(z) - n, 1 / (len(z) - n))
        negative_risk = wu @ s[n:] - wp @ s[:n]
        g = np.zeros_like(z)
        if negative_risk >= 0:
            g[:n] = -2 * wp * slope[:n]
            g[n:] = wu * slope[n:]
        else:
            g[:n] = wp * slope[:n]
            g[n:] = -wu * slope[n:]
        return g

    return QualityModel(mean, scale, train(np.concatenate((p, u)), gradient, hidden, steps, 0.01, 1e-5, seed), prior)


def learn_quality(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
    positives: int = 6000, unlabelled: int = 12000, seed: int = 9,
) -> QualityModel:
    """Fit on about `positives` rows labelled 1 and `unlabelled` rows of `docs`, chosen by key hash.

    Those two numbers bound the sample; their feature rows come to the driver, no texts. Labels of
    0 and null are not used; a key with differing labels is no trusted positive. With fewer than
    four rows of either kind, every score is 0.5.
    """
    small_batches(docs.sparkSession)
    trusted = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("k")).agg(F.min(label).alias("least")).filter("least = 1").select("k")
    )
    n_trusted, n_docs = trusted.count(), docs.count()
    chosen = F.broadcast(trusted.filter(sampled(F.col("k"), n_trusted, positives, seed)))  # `positives` keys
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    known = rows.join(chosen, "k", "left_semi").withColumn("p", F.lit(True))
    web = rows.filter(sampled(F.coalesce(F.col("k"), F.lit(0)), n_docs, unlabelled, seed + 1)).withColumn("p", F.lit(False))

    def featured(batches):
        make = Features()
        for b in batches:
            x = [make(t).astype("<f8").tobytes() for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("k").cast(pa.string()), b.column("p"), pa.array(x, pa.binary())], ["k", "p", "x"])

    got = sorted((r.p, r.k or "", bytes(r.x)) for r in known.unionByName(web).mapInArrow(featured, "k string, p boolean, x binary").collect())
    x = {p: np.array([np.frombuffer(r[2], "<f8") for r in got if r[0] is p]).reshape(-1, Features.size) for p in (True, False)}
    return fit_non_negative(x[True], x[False])


def score_quality(df: DataFrame, model: QualityModel, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """Add `score` (0 to 1, higher: likelier a positive) to `keep`, one row per input row.

    A null text is empty, and empty texts get a score too; other columns are not read.
    """

    def scores(texts):
        f = Features()
        x = np.array([f(t) for t in texts]).reshape(-1, Features.size)
        return [model.scores(x).tolist()]

    return mapped(df, text, keep, f"`{fresh('score', keep)}` double", scores)


@query()
def op9_quality(spark, sf_dir):
    """Quality of every document, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 4, 2))
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 4, 2))
    model = learn_quality(docs.filter(~F.col("held_out")), labels)
    scored = score_quality(docs, model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
