"""Benchmark passages in documents, found by greedy string tiling.

Runs of five words that a document shares with a benchmark item seed the comparison. For each item with
a seed, the longest match of both texts whose words are still free is marked as a tile,
again and again, until none of five words is left. Tiles may lie in any order, so a passage with its
sentences rearranged still counts. A document is contaminated by an item when its tiles cover a
given share of the item's words.

The benchmark is sent to every task in slices of bounded size. One that fits one slice, as benchmarks do, takes one pass
over the documents and no shuffle; a larger one takes a pass per slice.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from skywell.llm.common import fresh, query, shingles, small_batches, table, word_hashes

SEED = 5  # words
COVERAGE = 0.5  # of an item's words
SLICE = 1_000_000  # benchmark words sent at a time: about 40 MB
PAIRS = 1 << 20  # position pairs looked at together


@dataclass
class Items:
    """Benchmark items of a slice: their words, and where each run of words stands."""

    ids: list
    words: list[np.ndarray]
    size: int

    def __post_init__(self):
        self.by_length = {}
        for n in {min(self.size, len(w)) for w in self.words if len(w)}:
            chosen = [i for i, w in enumerate(self.words) if min(self.size, len(w)) == n]
            runs = [shingles(self.words[i], n) for i in chosen]
            keys = np.concatenate(runs)
            item = np.repeat(chosen, [len(r) for r in runs])
            at = np.concatenate([np.arange(len(r)) for r in runs])
            order = np.argsort(keys, kind="stable")
            maybe = np.zeros(1 << 18, np.bool_)
            maybe[keys >> np.uint64(46)] = True
            self.by_length[n] = keys[order], item[order], at[order], maybe

    def matches(self, words: np.ndarray):
        """For each item with a seed in `words`: `(item, maximal matches as [length, document, item position])`."""
        for n, (keys, item, at, maybe) in self.by_length.items():
            if len(words) < n:
                continue
            runs = shingles(words, n)
            here = np.flatnonzero(maybe[runs >> np.uint64(46)])
            low, high = np.searchsorted(keys, runs[here], "left"), np.searchsorted(keys, runs[here], "right")
            here, low, high = here[high > low], low[high > low], high[high > low]
            if len(here):
                yield from self.maximal(words, n, here, low, high, item, at)

    def maximal(self, words, n, here, low, high, item, at):
        """Runs of seeds on one diagonal are one match: it starts and ends where the neighbours differ."""
        starts, ends = [], []
        per, first = high - low, 0
        while first < len(here):
            last = max(first + 1, int(np.searchsorted(np.cumsum(per[first:]), PAIRS)) + first)
            count = per[first:last]
            d = np.repeat(here[first:last], count)
            which = np.repeat(low[first:last] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            i, j = item[which], at[which]
            offset = self.offsets[i]
            before = (d > 0) & (j > 0)
            before[before] = words[d[before] - 1] == self.flat[offset[before] + j[before] - 1]
            after = (d + n < len(words)) & (j + n < self.sizes[i])
            after[after] = words[d[after] + n] == self.flat[offset[after] + j[after] + n]
            for out, keep, shift in ((starts, ~before, 0), (ends, ~after, n)):
                out.append(np.stack((i[keep], d[keep] - j[keep], d[keep] + shift)))
            first = last
        s, e = (np.concatenate(x, axis=1) for x in (starts, ends))
        s, e = (x[:, np.lexsort((x[2], x[1], x[0]))] for x in (s, e))
        length = e[2] - s[2]
        bounds = np.flatnonzero(np.diff(s[0])) + 1
        for lo, hi in zip([0, *bounds], [*bounds, s.shape[1]]):
            yield int(s[0, lo]), [(-int(length[k]), int(s[2, k]), int(s[2, k] - s[1, k])) for k in range(lo, hi)]

    @property
    def flat(self):
        if "_flat" not in self.__dict__:
            self._flat = np.concatenate(self.words)
        return self._flat

    @property
    def sizes(self):
        if "_sizes" not in self.__dict__:
            self._sizes = np.array([len(w) for w in self.words])
        return self._sizes

    @property
    def offsets(self):
        if "_offsets" not in self.__dict__:
            self._offsets = np.cumsum(self.sizes) - self.sizes
        return self._offsets

    def covered(self, words: np.ndarray):
        """`(item number, words covered, tiles)` for every item with a seed; tiles are `(document, item, length)`."""
        for i, found in self.matches(words):
            tiles = tile(found, len(words), len(self.words[i]), min(self.size, len(self.words[i])))
            yield i, sum(t[2] for t in tiles), tiles


def tile(found: list[tuple], n_text: int, n_item: int, least: int) -> list[tuple]:
    """Greedy tiles from all maximal matches: the longest whose words are all free goes next.

    A match that lost words to a longer one returns as what is left of it. Ties go to the earlier
    position in the text, then in the item.
    """
    free_text, free_item = np.ones(n_text, np.bool_), np.ones(n_item, np.bool_)
    heap, tiles = list(found), []
    heapq.heapify(heap)
    while heap:
        size, d, j = heapq.heappop(heap)
        n = -size
        free = free_text[d : d + n] & free_item[j : j + n]
        if free.all():
            free_text[d : d + n] = free_item[j : j + n] = False
            tiles.append((d, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(heap, (a - b, d + a, j + a))
    return tiles


def slices(benchmark: DataFrame, text: str, key: str, size: int, limit: int):
    """The benchmark as `Items` of at most about `limit` words each."""
    words = F.coalesce(F.length(F.col(text)), F.lit(0)) / 4
    total = benchmark.agg(F.sum(words)).first()[0] or 0
    n = max(1, -int(-total // limit))
    part = benchmark.select(F.col(key).alias("k"), F.col(text).alias("t")).withColumn("p", F.pmod(F.xxhash64("k", "t"), F.lit(n)))
    for i in range(n):
        rows = sorted(((r.k, r.t) for r in part.filter(F.col("p") == i).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        hashed = [(k, word_hashes(t)) for k, t in rows]
        hashed = [(k, w) for k, w in hashed if len(w)]
        if hashed:
            yield Items([k for k, _ in hashed], [w for _, w in hashed], size)


TILES = "array<struct<text_word:long,item_word:long,words:long>>"


def find_contamination(
    df: DataFrame, benchmark: DataFrame, text: str = "text", keep: tuple = ("doc_id",), item_text: str = "text",
    item_key: str = "item_id", size: int = SEED, coverage: float = COVERAGE, limit: int = SLICE,
) -> DataFrame:
    """Pairs of a document and an item it holds: `keep`, the item's key, `coverage`, `tiles`.

    Words are lower case, punctuation separates them. An item shorter than a seed must be held
    whole; one without words, and a null text on either side, match nothing. Repeated documents
    repeat their pairs; other columns are not read; empty tables give no pair.
    """
    spark = df.sparkSession
    small_batches(spark)
    names = [fresh(n, keep) for n in (item_key, "coverage", "tiles")]
    body = fresh("text_", keep)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(body))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    kind = dict(benchmark.dtypes)[item_key]
    kinds = [to_arrow_type(f.dataType) for f in T._parse_datatype_string(f"i {kind}, c double, t {TILES}")]
    schema = f"{fields}`{names[0]}` {kind}, `{names[1]}` double, `{names[2]}` {TILES}"

    def passes(items: Items) -> DataFrame:
        sent = spark.sparkContext.broadcast(items)

        def search(batches):
            known = sent.value
            for b in batches:
                at, ids, shares, tiles = [], [], [], []
                for row, t in enumerate(b.column(b.num_columns - 1).to_pylist()):
                    for i, n, found in known.covered(word_hashes(t)):
                        if n >= coverage * len(known.words[i]):
                            at.append(row)
                            ids.append(known.ids[i])
                            shares.append(n / len(known.words[i]))
                            tiles.append([{"text_word": d, "item_word": j, "words": m} for d, j, m in sorted(found)])
                if at:
                    take = pa.array(at)
                    columns = [b.column(c).take(take) for c in range(b.num_columns - 1)]
                    made = [pa.array(x, k) for x, k in zip((ids, shares, tiles), kinds)]
                    yield pa.RecordBatch.from_arrays([*columns, *made], [*b.schema.names[:-1], *names])

        return rows.mapInArrow(search, schema)

    out = None
    for items in slices(benchmark, item_text, item_key, size, limit):
        out = passes(items) if out is None else out.unionByName(passes(items))
    return spark.createDataFrame([], schema) if out is None else out


def decontaminated(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id",
    size: int = SEED, coverage: float = COVERAGE, limit: int = SLICE,
) -> DataFrame:
    """The rows of `df` that hold no item, unchanged; the same rules as `find_contamination`."""
    spark = df.sparkSession
    small_batches(spark)
    column = df.columns.index(text)

    def passes(rows: DataFrame, items: Items) -> DataFrame:
        sent = spark.sparkContext.broadcast(items)

        def search(batches):
            known = sent.value
            for b in batches:
                clean = [
                    all(n < coverage * len(known.words[i]) for i, n, _ in known.covered(word_hashes(t)))
                    for t in b.column(column).to_pylist()
                ]
                yield b.filter(pa.array(clean, pa.bool_()))

        return rows.mapInArrow(search, rows.schema)

    for items in slices(benchmark, item_text, item_key, size, limit):
        df = passes(df, items)
    return df


@query()
def op8_decontaminate(spark, sf_dir):
    """Documents that hold benchmark items, with the share and number of their tiles."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", F.size("tiles").cast("long").alias("n_tiles"))
