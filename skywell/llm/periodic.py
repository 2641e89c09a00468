"""Periodic runs of words by recursive frequency splitting.

A run repeats a stretch of words at least four times over, so each of its words occurs at least four
times in whatever part of the text holds it. Words that occur less often in their segment end it there; the pieces
are segments of their own, split again until every word of a segment is frequent in it. Only those are
scanned for repeats, lag by lag: blocks of one lag's length are compared by their sums of hashed
words, and blocks that agree with the next one are followed word by word to both ends.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skywell.llm.common import BATCH_ROWS, fresh, mixed, query, small_batches, table

REPEATS = 4  # times a period fits in a run, at least
SHORTEST = 6  # words of a run, at least
_BASE = 0x9E3779B97F4A7C15 | 1


def segments(ids: np.ndarray, least: int = REPEATS, shortest: int = SHORTEST):
    """`(from, to)` of the parts in which every word occurs `least` times, of those that are long enough.

    Of the pieces of a split, the longest inherits its counts less those of the others, so a text of n words
    takes about n log n steps however deep it splits.
    """
    values = ids.tolist()
    where: dict = {}  # the places of each word, found when a split goes deeper
    work = [(0, len(values), None, ())]
    while work:
        lo, hi, counts, rare = work.pop()
        if hi - lo < shortest:
            continue
        if counts is None:
            counts = Counter(values[lo:hi])
            rare = {w for w, n in counts.items() if n < least}
            cuts = [i for i in range(lo, hi) if values[i] in rare] if rare else []
        else:
            if rare and not where:
                order = np.argsort(ids, kind="stable")
                bounds = np.flatnonzero(np.diff(ids[order])) + 1
                where.update((int(ids[p[0]]), p) for p in np.split(order, bounds))
            cuts = sorted(i for w in rare for i in where[w][slice(*np.searchsorted(where[w], (lo, hi)))].tolist())
        if not cuts:
            yield lo, hi
            continue
        edges = [lo - 1, *cuts, hi]
        pieces = [(a + 1, b) for a, b in zip(edges, edges[1:]) if b > a + 1]
        long = max(pieces, key=lambda p: p[1] - p[0], default=None)
        work += [(*p, None, ()) for p in pieces if p is not long]
        if long is None:
            continue
        if 2 * (long[1] - long[0]) < hi - lo:
            work.append((*long, None, ()))
            continue
        gone = Counter(values[lo : long[0]])
        gone.update(values[long[1] : hi])
        counts.subtract(gone)
        work.append((*long, counts, [w for w in gone if 0 < counts[w] < least]))


def equal_stretch(ids: np.ndarray, lag: int, at: int) -> tuple[int, int]:
    """The longest stretch around `at` in which each word equals the one `lag` further: from, to (exclusive, of the first words)."""
    lo, size = at, 16
    while lo > 0:
        a = max(lo - size, 0)
        other = np.flatnonzero(ids[a:lo] != ids[a + lag : lo + lag])
        if len(other):
            lo = a + int(other[-1]) + 1
            break
        lo, size = a, 2 * size
    hi, last, size = at, len(ids) - lag, 16
    while hi < last:
        b = min(hi + size, last)
        other = np.flatnonzero(ids[hi:b] != ids[hi + lag : b + lag])
        if len(other):
            hi += int(other[0])
            break
        hi, size = b, 2 * size
    return lo, hi


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """`(start, length, period)` of all maximal runs of a segment, by lag.

    A run of lag q holds three lags' words that equal those q further, so two whole blocks among those that
    start at multiples of q. Blocks inside a run of a shorter period belong to that run.
    """
    n = len(ids)
    power = np.full(n + 1, _BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    reach = np.zeros(n, np.int64)  # the furthest end of a run found so far that holds this word
    out = []
    for q in range(1, n // REPEATS + 1):
        block = sums[::q]
        block = block[1:] - block[:-1]
        same = np.flatnonzero(block[:-1] * power[q] == block[1:]) * q
        if len(same):
            same = same[reach[same] < same + 2 * q]
        least, end = max(SHORTEST, REPEATS * q) - q, -1
        for at in same.tolist():
            if at < end:
                continue
            lo, end = equal_stretch(ids, q, at)
            if end - lo >= least:
                out.append((lo, end - lo + q, q))
                reach[lo : end + q] = np.maximum(reach[lo : end + q], end + q)
            end = max(end, at + 1)
    return out


def periodic_runs(words: list) -> list[tuple[int, int, int]]:
    """`(start, length, period)` of all runs of a list of words, by start, then period."""
    if len(words) < SHORTEST:
        return []
    code: dict = {}
    ids = np.array([code.setdefault(w, len(code)) for w in words], np.int64)
    found = [(lo + s, n, q) for lo, hi in segments(ids) for s, n, q in runs_of(ids[lo:hi])]
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list) -> tuple | None:
    """The run with the greatest length over period; of equal ones the first, then that of the least period."""
    best = None
    for r in runs:  # in order of start and period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def find_runs(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, `n_words`, `runs` (array of `start`, `length`, `period`, by start and period), `best` (the strongest run, or null) and
    `collapsed`: the text's words, joined by one space, without what a run repeats after its first period.

    Words are separated by ASCII white space. A null text has no words. Repeated rows and null keys get a row each; an
    empty table has none; other columns are not read. Long texts are taken whole, in about n log n steps.
    """
    small_batches(df.sparkSession, BATCH_ROWS)
    names = [key, *(fresh(n, [key]) for n in ("n_words", "runs", "best", "collapsed"))]
    run = "struct<start:long,length:long,period:long>"
    made = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    rows = df.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("binary").alias(fresh("text_", [key])))

    def scan(batches):
        for b in batches:
            texts = [(t or b"").split() for t in b.column(1).to_pylist()]
            runs = [periodic_runs(words) for words in texts]
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
            columns = [
                b.column(0), pa.array([len(words) for words in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), structs([r for found in runs for r in found], made), type=pa.list_(made)),
                structs([strongest(r) for r in runs], made),
                pa.array([b" ".join(without_repeats(w, r)) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    out = f"`{key}` {dict(df.dtypes)[key]}, {names[1]} long, {names[2]} array<{run}>, {names[3]} {run}, {names[4]} string"
    return rows.mapInArrow(scan, out)


def without_repeats(words: list, runs: list) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), np.bool_)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def structs(rows: list, kind: pa.DataType) -> pa.Array:
    return pa.array([r if r is None else dict(zip(("start", "length", "period"), r)) for r in rows], kind)


def planted(docs: DataFrame) -> DataFrame:
    """`doc_id` and text of all documents, one in ten made periodic from some word on, as the contract of the query asks."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", h.alias("h"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = chosen.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    chosen = chosen.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("cast(g % greatest(n, 1) as int)"))
    chosen = chosen.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeats = "flatten(array_repeat(slice(words, a + 1, p), cast((n - a) div p + 1 as int)))"
    made = F.expr(f"array_join(concat(slice(words, 1, a), slice({repeats}, 1, n - a)), ' ')")
    return chosen.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@query()
def op13_runs(spark, sf_dir):
    """The periodic runs of every document, with checksums of the runs and of the text without its repeats."""
    found = find_runs(planted(table(spark, sf_dir, "documents")))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws("", r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
