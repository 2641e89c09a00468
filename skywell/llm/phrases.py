"""Phrase collocations by dynamic itemset counting.

The texts lie in a few shards that are scanned in turn, over and over. Words are counted from the first
scan on. A longer phrase becomes active in the scan after both of its subphrases (without its last and
without its first word) have reached the threshold, in whatever shard the cycle then is, and is
counted for one full cycle, so its count is that of all texts. Lengths are interleaved: a scan
counts words, pairs and triples at once. Scans end when no phrase is active.

What has reached the threshold is kept in one bit set of fixed size for each length, and each scan gets those of the
last cycle's steps. A phrase is active from the first step whose bit set holds both subphrases; as bits are only
ever added, every scan finds the same step for it, and takes part in its cycle or not. A bit set may hold a subphrase that has not
reached the threshold; the phrase is then counted in vain, for it can't reach it either.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from skywell.llm.common import BATCH_ROWS, discard, mixed, query, small_batches, table, written

SHARDS = 2
LEAST = 10  # occurrences of a candidate
LONGEST = 3  # words of a candidate
COVERED = 50  # per cent of a phrase's occurrences that a longer candidate must hold to replace it
TOP = 2000
BLOCK = 6 << 20  # bytes of text counted together
BITS = 1 << 26  # of a bit set, at most: 8 MB
SLICES = 64  # in which a bit set is put together
PROBES = 4
STOPS = b".,;:!?\x0a\x0b\x0c\x0d"  # fixed values: what separates pieces, and words
BLANKS = b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(STOPS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def parts(text: bytes, limit: int = BLOCK, longest: int = LONGEST):
    """`(part, weight)` of a long text, each about `limit` long: weighted counts of the parts are the text's counts.

    A text is cut between pieces. A piece that is longer itself is cut into parts that share a few words,
    which are then counted once more with weight -1.
    """
    at = 0
    while len(text) - at > limit:
        end = max(text.rfind(bytes([s]), at, at + limit) for s in STOPS) + 1
        if end > at:
            yield text[at:end], 1
            at = end
            continue
        window = np.frombuffer(text, np.uint8, -1, at)
        inside = _KIND[window[: 2 * limit]] == 0  # words that start in the window's second half are shared
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        k = int(np.searchsorted(starts, limit))
        if k + longest - 1 >= len(starts):  # few and very long words
            yield text[at:], 1
            return
        a, b = int(starts[k]), int(starts[k + longest - 1])
        yield text[at : at + b], 1
        yield text[at + a : at + b], -1
        at += a
    yield text[at:], 1


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of binary texts, dictionary-encoded, with the number of each one's text and of its piece."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kind = _KIND[raw]
    edge = np.zeros(len(raw) + 1, np.bool_)
    edge[bounds] = True
    inside = np.zeros(len(raw) + 2, np.bool_)
    inside[1:-1] = kind == 0
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    piece = np.cumsum((kind == 2) | edge[:-1], dtype=np.int32)[starts]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    data = np.ascontiguousarray(_LOWER[raw[inside[1:-1]]])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words.dictionary_encode(), np.searchsorted(bounds, starts, "right") - 1, piece


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each binary value."""
    bounds = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    lengths = np.diff(bounds)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(raw)) - np.repeat(bounds[:-1] - bounds[0], lengths)
    power = np.full(int(lengths.max(initial=0)) + 1, _BASE)
    power[0] = 1
    terms = np.concatenate((raw * np.cumprod(power)[place], np.zeros(1, np.uint64)))
    sums = np.add.reduceat(terms, bounds[:-1] - bounds[0]) if len(words) else np.zeros(0, np.uint64)
    return mixed(np.where(lengths > 0, sums, np.uint64(0)) + lengths.astype(np.uint64) * _BASE)


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its start and its last word."""
    return mixed(a * np.uint64(0xD6E8FEB86659FD93) + b)


def probes(h: np.ndarray, bits: int):
    step = (h >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (h + np.uint64(i) * step) & np.uint64(bits - 1)


def may_hold(held: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the bit set: yes for all that are in it."""
    out = np.ones(len(h), np.bool_)
    for at in probes(h, 8 * len(held)):
        out &= (held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0
    return out


def first_held(sets: list, h: np.ndarray) -> np.ndarray:
    """The number of the first of the growing bit sets that holds each hash; that of all sets if none does."""
    out = np.full(len(h), len(sets), np.int8)
    left = np.arange(len(h))
    for i in range(len(sets) - 1, -1, -1):
        left = left[may_hold(sets[i], h[left])]
        out[left] = i
    return out


class Block:
    """Counts of the phrases of some texts: `(language, words in the phrase, phrase, count)`."""

    def __init__(self, texts: pa.Array, languages: pa.Array, weights: np.ndarray):
        words, text, piece = words_of(texts)
        spoken = languages.dictionary_encode()
        self.languages, language = spoken.dictionary, spoken.indices.to_numpy()
        self.words = words.dictionary
        code = words.indices.to_numpy().astype(np.int64)
        both = language[text].astype(np.int64) * len(self.words) + code if len(code) else code
        self.kinds, self.at = np.unique(both, return_inverse=True)  # a word in a language
        self.language = self.kinds // max(len(self.words), 1)
        self.word = self.kinds % max(len(self.words), 1)
        self.piece, self.weight = piece, weights[text]
        self.hash = joined(hashes(self.languages)[self.language], hashes(self.words)[self.word]) if len(code) else np.zeros(0, np.uint64)

    def follow(self, n: int) -> np.ndarray:
        """Positions at which a phrase of `n` words starts."""
        return np.flatnonzero(self.piece[: len(self.piece) - n + 1] == self.piece[n - 1 :])

    def rows(self, n: int, starts: np.ndarray, since: np.ndarray) -> pa.RecordBatch:
        """The phrases of `n` words at `starts`, each once, with its count and the step it is active from."""
        ids = self.at[starts]
        for k in range(1, n):
            _, ids = np.unique(ids * len(self.kinds) + self.at[starts + k], return_inverse=True)
        _, first, ids = np.unique(ids, return_index=True, return_inverse=True)
        count = np.bincount(ids, self.weight[starts], len(first)).astype(np.int64)
        since, first = since[first], starts[first]
        spelled = [self.words.take(pa.array(self.word[self.at[first + k]])) for k in range(n)]
        phrase = pc.binary_join_element_wise(*spelled, b" ") if n > 1 else spelled[0]
        language = self.languages.take(pa.array(self.language[self.at[first]]))
        kept = pa.array(count != 0)
        made = [language.cast(pa.string()), pa.array(np.full(len(first), n, np.int32)), phrase.cast(pa.string()), pa.array(count), pa.array(since.astype(np.int32))]
        return pa.RecordBatch.from_arrays([c.filter(kept) for c in made], ["lang", "n_words", "phrase", "c", "start"])

    def counted(self, words: bool, sets: dict, step: int, shards: int):
        """What is counted in this step: words where they are asked for, and the longer phrases that are active.

        `sets` has for a length the bit sets of subphrases, of this step and of those before, as far back as a cycle.
        """
        if words and len(self.at):
            yield self.rows(1, np.arange(len(self.at)), np.zeros(len(self.at), np.int32))
        starts = np.arange(len(self.at))
        for n in range(2, max(sets, default=1) + 1):
            at = self.follow(n)
            if n in sets:
                held, oldest = sets[n], step - len(sets[n]) + 1
                seen = np.full(len(self.at), len(held), np.int8)
                seen[starts] = first_held(held, self.hash)[self.at] if n == 2 else first_held(held, h)
                since = np.maximum(seen[at], seen[at + 1]).astype(np.int32)
                now = (since < len(held)) & (since + oldest > step - shards)
                if now.any():
                    yield self.rows(n, at[now], since[now] + oldest)
            whole = np.zeros(len(self.at), np.uint64)
            whole[starts] = self.hash[self.at] if n == 2 else h
            h = joined(whole[at], self.hash[self.at[at + n - 1]])
            starts = at


def phrase_hashes(languages: pa.Array, phrases: pa.Array) -> np.ndarray:
    """The hashes of whole phrases, as blocks compute them."""
    spoken = languages.dictionary_encode()
    split = pc.split_pattern(phrases, b" ")
    words = split.flatten().dictionary_encode()
    code, offsets = hashes(words.dictionary)[words.indices.to_numpy()], split.offsets.to_numpy() - split.offsets[0].as_py()
    tongue = hashes(spoken.dictionary)[spoken.indices.to_numpy()]
    out = joined(tongue, code[offsets[:-1]])
    lengths = np.diff(offsets)
    for k in range(1, int(lengths.max(initial=1))):
        more = lengths > k
        out[more] = joined(out[more], joined(tongue[more], code[offsets[:-1][more] + k]))
    return out


def bit_sets(phrases: DataFrame, bits: int) -> dict:
    """Bit sets of `bits` bits of the phrases `n_words`, `lang`, `phrase`, by number of words.

    Each task sends the places of its bits once, by slices of a set; slices are put together by their own
    tasks, and only the sets come here.
    """
    size = bits // SLICES

    def spread(batches):
        found: dict = {}
        for b in batches:
            h, n = phrase_hashes(b.column(1).cast(pa.binary()), b.column(2).cast(pa.binary())), b.column(0).to_numpy()
            for k in np.unique(n).tolist():
                found.setdefault(k, []).append(np.concatenate(list(probes(h[n == k], bits))).astype("<u4"))
        for k, at in found.items():
            at = np.unique(np.concatenate(at))
            part, starts = np.unique(at // size, return_index=True)
            cut = [pa.scalar((x % size).tobytes(), pa.binary()) for x in np.split(at, starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(part), pa.int32()), pa.array(part.astype(np.int32)), pa.array(cut)], ["n_words", "part", "at"])

    def put(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = np.zeros(size, np.bool_)
        for b in batches:
            for x in b.column("at").to_pylist():
                made[np.frombuffer(x, "<u4")] = True
        packed = pa.array([np.packbits(made, bitorder="little").tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([*(pa.array([k.as_py()], pa.int32()) for k in key), packed], ["n_words", "part", "bits"])

    places = phrases.select("n_words", "lang", "phrase").mapInArrow(spread, "n_words int, part int, at binary")
    out: dict = {}
    for r in places.groupBy("n_words", "part").applyInArrow(put, "n_words int, part int, bits binary").collect():
        held = out.setdefault(r.n_words, np.zeros(bits // 8, np.uint8))
        held[r.part * (size // 8) : (r.part + 1) * (size // 8)] = np.frombuffer(r.bits, np.uint8)
    return out


def scanned(shard: DataFrame, step: int, shards: int, sent, block: int, longest: int) -> DataFrame:
    """`lang`, `n_words`, `phrase`, `c`, `start` of one scan of a shard, one row per phrase and block of text."""

    def scan(batches):
        held, size = [], 0

        def flush():
            yield from Block(pa.array([x[0] for x in held], pa.binary()), pa.array([x[1] for x in held], pa.binary()),
                             np.array([x[2] for x in held], np.int64)).counted(step < shards, sent.value, step, shards)

        for b in batches:
            for text, language in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(0).cast(pa.binary()).to_pylist()):
                for part, weight in parts(text, block, longest):
                    held.append((part, language, weight))
                    size += len(part)
                    if size >= block:
                        yield from flush()
                        held, size = [], 0
        if held:
            yield from flush()

    return shard.mapInArrow(scan, "lang string, n_words int, phrase string, c long, start int")


def phrase_counts(
    df: DataFrame, text: str = "text", language: str = "lang", least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS,
    block: int = BLOCK,
) -> list[DataFrame]:
    """Written tables of `lang`, `phrase`, `c` by words in the phrase: all words, then all longer phrases that occur `least` times.

    A null text is empty, a null language `und`. Repeated rows count each time; other columns are not read. An empty
    table has no phrases.
    """
    spark = df.sparkSession
    small_batches(spark, BATCH_ROWS)
    rows = df.select(F.coalesce(F.col(f"`{language}`"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    corpus = written(rows.withColumn("shard", F.monotonically_increasing_id() % shards), "shard")
    size = corpus.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(BITS, 1 << max(16, int(size // 16).bit_length()))  # a known phrase takes some ten words, about sixty bytes, at least
    still, done = None, []  # phrases that are being counted; those that were for a cycle, and occur often enough
    sets: dict = {n: [np.zeros(bits // 8, np.uint8)] for n in range(2, longest + 1)}  # by step, as far back as a cycle
    step = 0
    while True:
        # a length whose bit set is that of a cycle ago has no active phrase
        active = {n: s for n, s in sets.items() if len(s) <= shards or not np.array_equal(s[0], s[-1])} if step else {}
        if step >= shards and not active:
            break
        sent = spark.sparkContext.broadcast(active)
        found = scanned(corpus.filter(F.col("shard") == step % shards).select("lang", "text"), step, shards, sent, block, longest)
        if still is not None:
            found = found.unionByName(still)
        # few rows are equal before they are shuffled: a block sends each phrase once
        sums = found.repartition("lang", "phrase").groupBy("lang", "n_words", "phrase").agg(F.sum("c").alias("c"), F.min("start").alias("start"))
        ended = F.col("start") + shards - 1 <= step
        rows = written(sums.filter(~ended | (F.col("c") >= least) | (F.col("n_words") == 1)))
        known = bit_sets(rows.filter((F.col("c") >= least) & (F.col("n_words") < longest)), bits)
        for n, s in sets.items():
            s.append(s[-1] | known[n - 1] if n - 1 in known else s[-1])
            del s[: -shards - 1]
        discard(still)
        sent.destroy()
        done.append(rows.filter(ended))
        still = rows if step < shards - 1 else rows.filter(~ended)
        step += 1
    discard(corpus)
    out = []
    for n in range(1, longest + 1):
        tables = [t.filter(F.col("n_words") == n).select("lang", "phrase", "c") for t in done[shards - 1 :]]
        whole = tables[0]
        for t in tables[1:]:
            whole = whole.unionByName(t)
        out.append(whole)
    return out


def collocations(
    df: DataFrame, text: str = "text", language: str = "lang", least: int = LEAST, longest: int = LONGEST, covered: int = COVERED,
    top: int | None = TOP, shards: int = SHARDS, block: int = BLOCK,
) -> DataFrame:
    """The best phrases of each language: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    A phrase of two to `longest` words that occurs `a >= least` times is a candidate. Cut after some word, its parts
    occur `l` and `r` times; the cut with the least `floor(1000000 a a / (l r))` counts, the first of equals.
    A candidate inside a longer one that has `covered` per cent of its occurrences is dropped. `n`: words of the language.
    Ranks go by score, then `a` (both falling), then the phrase's bytes; `top` of None returns all. Products are exact
    for counts below 10^15. Nulls, repeats, empty tables and other columns: as in `phrase_counts`.
    """
    counts = phrase_counts(df, text, language, least, longest, shards, block)
    total = counts[0].groupBy("lang").agg(F.sum("c").alias("n"))
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    found = []
    for n in range(2, longest + 1):
        rows = counts[n - 1].withColumnRenamed("c", "a")
        for k in range(1, n):
            at = F.expr(f"char_length(substring_index(phrase, ' ', {k}))")
            rows = rows.withColumn("first", F.substring_index("phrase", " ", k)).withColumn("rest", F.col("phrase").substr(at + 2, F.char_length("phrase")))
            l, r = (counts[i - 1].filter(F.col("c") >= least).select("lang", F.col("phrase").alias(c), F.col("c").alias(f"{x}{k}")) for i, c, x in ((k, "first", "l"), (n - k, "rest", "r")))
            rows = rows.join(l, ["lang", "first"]).join(r, ["lang", "rest"]).drop("first", "rest")
            product = F.lit(1000000).cast("decimal(7,0)") * (wide("a") * wide("a"))
            rows = rows.withColumn("top", product).withColumn("bottom", wide(f"l{k}") * wide(f"r{k}")).withColumn(f"s{k}", F.expr("top div bottom")).drop("top", "bottom")
        cut = F.least(*[F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, n)]) if n > 2 else F.struct(F.col("s1").alias("score"), F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r"))
        found.append(written(rows.select("lang", "phrase", F.lit(n).alias("words"), "a", cut.alias("cut")).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")))
    inner = []
    for n in range(3, longest + 1):
        for m in range(2, n):
            for at in range(n - m + 1):
                part = F.expr(f"concat_ws(' ', slice(split(phrase, ' '), {at + 1}, {m}))")
                inner.append(found[n - 2].select("lang", part.alias("phrase"), F.col("a").alias("longer")))
    kept = found[0]
    for t in found[1:]:
        kept = kept.unionByName(t)
    if inner:
        longer = inner[0]
        for t in inner[1:]:
            longer = longer.unionByName(t)
        longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        kept = kept.join(longer, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {covered} * a")
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    # written before the few totals are attached, so that the ranking keeps only what each task needs to send
    ranked = written(ranked)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL_WORDS = r"""
WITH pieces AS (
    SELECT lang, d, p, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS ws FROM (
        SELECT coalesce(lang, 'und') AS lang, d, unnest(ps) AS piece, generate_subscripts(ps, 1) AS p FROM (
            SELECT lang, row_number() OVER () AS d, string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\f\r]') AS ps
            FROM documents))),
placed AS (SELECT lang, d, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM pieces),
follow AS (SELECT lang, w, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM placed WINDOW s AS (PARTITION BY d, p ORDER BY i)),
ones AS (SELECT lang, w AS phrase, count(*) AS c FROM placed GROUP BY ALL),
twos AS (SELECT lang, w, w2, w || ' ' || w2 AS phrase, count(*) AS c FROM follow WHERE w2 IS NOT NULL GROUP BY ALL),
threes AS (SELECT lang, w, w2, w3, w || ' ' || w2 || ' ' || w3 AS phrase, count(*) AS c FROM follow WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
    SELECT t.lang, t.phrase, t.c AS a, 1 AS k, a.c AS l, b.c AS r FROM twos t
    JOIN ones a ON a.lang = t.lang AND a.phrase = t.w JOIN ones b ON b.lang = t.lang AND b.phrase = t.w2 WHERE t.c >= 10
    UNION ALL
    SELECT t.lang, t.phrase, t.c, 1, a.c, b.c FROM threes t
    JOIN ones a ON a.lang = t.lang AND a.phrase = t.w JOIN twos b ON b.lang = t.lang AND b.w = t.w2 AND b.w2 = t.w3
    UNION ALL
    SELECT t.lang, t.phrase, t.c, 2, a.c, b.c FROM threes t
    JOIN twos a ON a.lang = t.lang AND a.w = t.w AND a.w2 = t.w2 JOIN ones b ON b.lang = t.lang AND b.phrase = t.w3),
scored AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, phrase, max(c) AS c FROM (
        SELECT lang, w || ' ' || w2 AS phrase, c FROM threes UNION ALL SELECT lang, w2 || ' ' || w3, c FROM threes) GROUP BY ALL),
ranked AS (
    SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase, a, l, r, score
    FROM best b LEFT JOIN longer x ON x.lang = b.lang AND x.phrase = b.phrase WHERE x.c IS NULL OR 100 * x.c < 50 * a)
SELECT k.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked k
JOIN (SELECT lang, sum(c) AS n FROM ones GROUP BY lang) t ON t.lang = k.lang WHERE rank <= 2000
"""


@query(SQL_WORDS)
def op11_phrases(spark, sf_dir):
    """The best phrases of two and three words of every language."""
    return collocations(table(spark, sf_dir, "documents"))
