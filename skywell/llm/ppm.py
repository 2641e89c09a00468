"""Prediction by partial matching: how likely a model of byte contexts finds each document.

The model is a trie of byte contexts up to five long with the counts of what followed them in the
training texts; a shorter context counts a symbol once for each longer one that it followed. A symbol is
coded in the longest context that has been seen, as `(2 count - 1) / (2 total)`; one that never followed it is
escaped with the estimate `distinct / (2 total)` to the next shorter context, in which
all symbols of the longer are excluded; below the empty context all symbols left are equally likely.

Counting and coding go by blocks of documents. A block gives each of its distinct words and byte
runs once, with its training count; each word and run is gathered once, with its count and the blocks that have it. The model
is built from these by joins, the codes of every distinct run are worked out once, and each block gets back the
values of its own runs and words, packed in arrays. So what is
shuffled is what blocks have in them, not every position, and no table of the whole corpus stands in one
place: the trie is shuffled by context and grows with the corpus. Only contexts of at most one byte, 66,306 rows
at most, are broadcast.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from skywell.llm.common import discard, fresh, held_out, query, release, small_batches, table, written

ORDER = 5  # bytes of the longest context
BITS, END, SYMBOLS = 9, 257, 257  # a byte b is symbol b + 1; 0 stands before the text; 257 ends it
BLOCK = 24 << 20  # characters of a block of documents, about
GATHERED = 1 << 20  # words or runs of blocks that are gathered in a task, about
PART, WORDS = 1 << 18, 1 << 21  # bytes coded, and bytes whose words are looked up, at a time


def lowered(texts) -> pa.Array:
    """Texts with ASCII letters in lower case; a null is empty."""
    flat = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    return pc.ascii_lower(pc.fill_null(flat.cast(pa.large_string()), ""))


def parts(texts: pa.Array, most: int = PART):
    """Slices of texts of about `most` bytes together: `(first, number)`."""
    sizes = pc.binary_length(texts).to_numpy()
    first, room = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if room + n > most and i > first:
            yield first, i - first
            first, room = i, 0
        room += n
    if len(sizes) > first:
        yield first, len(sizes) - first


def runs_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every context with its symbol, packed in a number, for all texts in turn, and each text's number of them."""
    sizes = pc.binary_length(texts).to_numpy()
    bounds = texts.buffers()[1]
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts = np.cumsum(sizes + ORDER + 1) - (sizes + ORDER + 1)  # a text, with what stands before it and its end
    symbols = np.zeros(int((sizes + ORDER + 1).sum()), np.int64)
    shift = np.repeat(starts + ORDER - (offsets[:-1] - offsets[0]), sizes)
    symbols[shift + np.arange(len(raw))] = raw.astype(np.int64) + 1
    symbols[starts + ORDER + sizes] = END
    codes = symbols[: len(symbols) - ORDER].copy()
    for i in range(1, ORDER + 1):
        codes <<= BITS
        codes |= symbols[i : len(symbols) - ORDER + i]
    inside = np.ones(len(codes), np.bool_)
    for i in range(ORDER):  # windows that reach from one text into the next
        inside[(starts[1:] - 1 - i)] = False
    return codes[inside], sizes + 1


class Places:
    """Where each of a set of distinct numbers stands, by open addressing over arrays."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, np.int32)
        free = np.ones(1 << bits, np.bool_)
        slot, left = self.slot(keys), np.arange(len(keys))
        while len(left):
            at = slot[left]
            ok = free[at]
            self.table[at[ok]] = left[ok]
            won = ok & (self.table[at] == left)
            free[at[won]] = False
            left = left[~won]
            slot[left] = (slot[left] + 1) & self.mask

    def slot(self, x: np.ndarray) -> np.ndarray:
        return ((x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Positions of `x`, all of which are among the keys."""
        slot = self.slot(x)
        out = self.table[slot]
        left = np.flatnonzero(self.keys[out] != x)
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            out[left] = self.table[slot[left]]
            left = left[self.keys[out[left]] != x[left]]
        return out


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often, or with what total weight, each occurs."""
    if weights is None:
        return np.unique(values, return_counts=True)
    unique, at = np.unique(values, return_inverse=True)
    return unique, np.bincount(at, weights, len(unique)).astype(np.int64)


def contents(block: pa.Table) -> pa.Table:
    """Distinct words and byte runs of a block's texts with their counts in its training texts."""
    number = block.column("block")[0].as_py()
    texts = lowered(block.column("text"))
    learn = block.column("learn").combine_chunks()
    words, codes = [], []
    for trained in (True, False):
        chosen = texts.filter(learn if trained else pc.invert(learn))
        for first, n in parts(chosen, WORDS):
            kinds = pc.value_counts(pc.ascii_split_whitespace(chosen.slice(first, n)).flatten())
            real = pc.not_equal(kinds.field("values"), "")
            words.append(pa.table({"w": kinds.field("values"), "n": pa.array(kinds.field("counts").to_numpy() * trained)}).filter(real))
        for first, n in parts(chosen):
            code, count = counted(runs_of(chosen.slice(first, n))[0])
            codes.append((code, count * trained))
            if sum(len(c) for c, _ in codes) > 1 << 20:
                codes = [counted(*(np.concatenate(x) for x in zip(*codes)))]
    code, code_count = counted(*(np.concatenate(x) for x in zip(*codes)))  # a block has a row, so a part
    kinds = pa.concat_tables(words).group_by("w").aggregate([("n", "sum")])
    word, word_count = kinds.column("w").combine_chunks(), kinds.column("n_sum").combine_chunks()
    total = len(word) + len(code)
    return pa.table({
        "block": pa.array(np.full(total, number)),
        "word": pa.concat_arrays([word.cast(pa.string()), pa.nulls(len(code), pa.string())]),
        "run": pa.concat_arrays([pa.nulls(len(word), pa.int64()), pa.array(code)]),
        "n": pa.concat_arrays([word_count.cast(pa.int64()), pa.array(code_count, pa.int64())]),
    })


def gathered(inside: DataFrame, key: str, kind: str) -> DataFrame:
    """Each distinct `key` of all blocks: its count `c`, and the numbers of the blocks that have it, packed; written."""
    rows = inside.filter(F.col(key).isNotNull()).select("block", key, "n")
    groups = max(1, -(-rows.count() // GATHERED))

    def gather(part: pa.Table) -> pa.Table:
        keys = part.column(key).combine_chunks()
        coded = keys.dictionary_encode()
        at = coded.indices.to_numpy()
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        count = np.add.reduceat(part.column("n").to_numpy()[order], starts)
        blocks = np.ascontiguousarray(part.column("block").to_numpy()[order].astype("<i8"))
        bounds = (np.append(starts, len(at)) * 8).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(blocks)])
        return pa.table([coded.dictionary, pa.array(count, pa.int64()), packed], [key, "c", "blocks"])

    dealt = rows.withColumn("p", F.pmod(F.xxhash64(key), F.lit(groups))).groupBy("p")
    return written(dealt.applyInArrow(lambda part: gather(part.drop(["p"])), f"{key} {kind}, c long, blocks binary"))


BACK = "b long, words string, runs binary, values binary"


def handed_back(found: DataFrame, key: str) -> DataFrame:
    """`key`, `value` of `found` for each of its `blocks`: rows of a block with many keys and values, packed."""

    def spread(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.column(1).nbytes // 8
            if size >= GATHERED:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def packed(held):
        t = pa.Table.from_batches(held)
        lists = t.column(1).to_pylist()
        blocks = np.frombuffer(b"".join(lists), "<i8")
        at = np.repeat(np.arange(len(lists)), [len(x) // 8 for x in lists])
        order = np.argsort(blocks, kind="stable")
        at, blocks = at[order], blocks[order]
        bounds = np.append(np.flatnonzero(np.diff(blocks, prepend=-1)), len(blocks))
        values = t.column(2).to_numpy()
        keys = t.column(0).combine_chunks() if key == "word" else t.column(0).to_numpy()
        cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        number = pa.array(blocks[bounds[:-1]], pa.int64())
        value = pa.array([values[at[i:j]].tobytes() for i, j in cuts], pa.binary())
        if key == "word":
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), keys.take(pa.array(at)))
            return pa.RecordBatch.from_arrays([number, pc.binary_join(lists, " "), pa.nulls(len(cuts), pa.binary()), value], ["b", "words", "runs", "values"])
        run = pa.array([keys[at[i:j]].tobytes() for i, j in cuts], pa.binary())
        return pa.RecordBatch.from_arrays([number, pa.nulls(len(cuts), pa.string()), run, value], ["b", "words", "runs", "values"])

    return found.select(key, "blocks", F.col("value").cast("double").alias("value")).mapInArrow(spread, BACK)


def suffix(run: str | Column, symbols: int) -> Column:
    """The last `symbols` symbols of a packed run."""
    return F.col(run).bitwiseAND(F.lit((1 << (BITS * symbols)) - 1)) if isinstance(run, str) else run.bitwiseAND(F.lit((1 << (BITS * symbols)) - 1))


def trie(runs: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per context length 0..ORDER: entries `run`, `c`, and contexts `ctx`, `n`, `q`, `rest_n`, `rest_q`.

    `runs` are the counted runs of the training texts. `n` is the total count in a context and `q` its
    distinct symbols; `rest_n` and `rest_q` are those of the next shorter context without the
    symbols that this context has.
    """
    entries = [None] * ORDER + [written(runs)]
    for k in range(ORDER - 1, -1, -1):
        shorter = entries[k + 1].groupBy(suffix("run", k + 1).alias("run")).agg(F.count("*").alias("c"))
        entries[k] = written(shorter) if k > 1 else F.broadcast(written(shorter))
    contexts = []
    for k in range(ORDER + 1):
        own = entries[k].withColumn("ctx", F.shiftright("run", BITS))
        if k:
            below = entries[k - 1].select(F.col("run").alias("short"), F.col("c").alias("c_short"))
            own = own.withColumn("short", suffix("run", k)).join(below, "short")
        else:
            own = own.withColumn("c_short", F.lit(0))
        sums = own.groupBy("ctx").agg(F.sum("c").alias("n"), F.count("*").alias("q"), F.sum("c_short").alias("excluded"))
        if k:
            up = contexts[k - 1].select(F.col("ctx").alias("up"), F.col("n").alias("up_n"), F.col("q").alias("up_q"))
            sums = sums.withColumn("up", suffix("ctx", k - 1) if k > 1 else F.lit(0).cast("long")).join(up, "up")
            sums = sums.select("ctx", "n", "q", (F.col("up_n") - F.col("excluded")).alias("rest_n"), (F.col("up_q") - F.col("q")).alias("rest_q"))
        else:
            sums = sums.select("ctx", "n", "q", F.lit(0).cast("long").alias("rest_n"), F.lit(0).cast("long").alias("rest_q"))
        contexts.append(written(sums) if k > 1 else F.broadcast(written(sums)))
    return entries, contexts


def coded(runs: DataFrame, entries: list[DataFrame], contexts: list[DataFrame]) -> DataFrame:
    """`run` and `value`, the log10 probability of its last symbol after the others, for distinct `runs`."""
    df = runs.select("run")
    for k in range(ORDER, -1, -1):
        entry = entries[k].select(F.col("run").alias(f"r{k}"), F.col("c").alias(f"c{k}"))
        context = contexts[k].select(F.col("ctx").alias(f"x{k}"), *[F.col(a).alias(f"{a}{k}") for a in ("n", "q", "rest_n", "rest_q")])
        df = df.withColumns({f"r{k}": suffix("run", k + 1), f"x{k}": F.shiftright(suffix(F.col("run"), k + 1), BITS)})
        df = df.join(entry, f"r{k}", "left").join(context, f"x{k}", "left")
    p = F.lit(1.0)  # of the symbol at or below the order, as seen from the next longer one that is known
    first = F.lit(1.0)  # the same where no longer context is known
    for k in range(-1, ORDER + 1):
        if k < 0:
            seen = F.coalesce(F.col("q0"), F.lit(0))
            p = first = 1.0 / F.greatest(F.lit(SYMBOLS) - seen, F.lit(1)).cast("double")
            continue
        c, n, q = (F.col(f"{a}{k}").cast("double") for a in ("c", "n", "q"))
        whole = F.when(c.isNotNull(), (2 * c - 1) / (2 * n)).otherwise(q / (2 * n) * p)
        first = F.when(n.isNull(), first).otherwise(whole)
        if k < ORDER:
            rest_n, rest_q = F.col(f"rest_n{k + 1}").cast("double"), F.col(f"rest_q{k + 1}").cast("double")
            p = F.when(c.isNotNull(), (2 * c - 1) / (2 * rest_n)).when(rest_n > 0, rest_q / (2 * rest_n) * p).otherwise(p)
    return df.select("run", F.log10(first).alias("value"))


def score_block(totals: dict):
    """Scores of a block's documents from the values of its words and runs."""

    def score(docs: pa.Table, values: pa.Table) -> pa.Table:
        names = ["k", "held_out", "n_tokens", "n_known", "base_score", "score"]
        kinds = [docs.schema.field("k").type if docs.num_rows else pa.null(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not docs.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        words = values.filter(pc.is_valid(values.column("words")))
        runs = values.filter(pc.is_valid(values.column("runs")))
        numbers = lambda column, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in column.to_pylist())])
        known = pc.list_flatten(pc.split_pattern(words.column("words"), " ")).combine_chunks().cast(pa.large_string())
        counts = np.concatenate((numbers(words.column("values"), float), [totals["ends"]]))
        bits = np.log10((counts + 0.5) / (totals["tokens"] + 0.5 * (totals["distinct"] + 1)))
        places, run_value = Places(numbers(runs.column("runs"), np.int64)), numbers(runs.column("values"), float)
        texts = lowered(docs.column("text"))
        out = [[], [], [], []]
        for first, n in parts(texts, WORDS):
            split = pc.ascii_split_whitespace(texts.slice(first, n))
            flat = split.flatten()
            doc = np.repeat(np.arange(n), np.diff(split.offsets.to_numpy()))
            real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
            at = pc.index_in(flat.filter(pa.array(real)), known).to_numpy()
            at, doc = np.concatenate((at, np.full(n, len(known)))), np.concatenate((doc[real], np.arange(n)))
            out[0].append(np.bincount(doc, minlength=n))
            out[1].append(np.bincount(doc, counts[at] > 0, n).astype(np.int64))
            out[2].append(np.bincount(doc, bits[at], n))
        for first, n in parts(texts):
            codes, sizes = runs_of(texts.slice(first, n))
            out[3].append(np.bincount(np.repeat(np.arange(n), sizes), run_value[places(codes)], n))
        columns = [docs.column("k"), pc.invert(docs.column("learn")), *[pa.array(np.concatenate(c)) for c in out]]
        return pa.table([c.cast(t) for c, t in zip(columns, kinds)], names)

    return score


def score_documents(df: DataFrame, is_held_out: Column, text: str = "text", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """Key, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`, a row per input row.

    Rows for which `is_held_out` is true are not learnt from. A null text is empty: one end. Without any
    training row no symbol is known and all are equally likely. Rows go to blocks by a hash of
    key and text, so neither a hot key nor a hot text gathers; repeated rows repeat; other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark, 2_000)  # blocks come whole, most of their rows are words and runs
    kind = dict(df.dtypes)[key]
    rows = df.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), (~is_held_out).alias("learn"))
    ends, characters = rows.agg(F.count(F.when(F.col("learn"), 1)), F.sum(F.length("text"))).first()
    blocks = max(1, -(-(characters or 0) // block))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("k", "text"), F.lit(blocks)))
    inside = written(rows.groupBy("block").applyInArrow(contents, "block long, word string, run long, n long"))
    release(spark)

    words, runs = gathered(inside, "word", "string"), gathered(inside, "run", "long")
    discard(inside)
    release(spark)
    entries, contexts = trie(runs.filter("c > 0").select("run", "c"))
    codes = written(coded(runs, entries, contexts))
    for t in (*entries, *contexts):
        discard(t)
    totals = words.filter("c > 0").agg(F.sum("c").alias("tokens"), F.count("*").alias("distinct")).first()
    totals = {"ends": ends, "tokens": (totals.tokens or 0) + ends, "distinct": totals.distinct + (ends > 0)}
    release(spark)
    back = handed_back(words.withColumn("value", F.col("c")), "word").unionByName(handed_back(runs.join(codes, "run"), "run"))
    out = rows.groupBy("block").cogroup(back.groupBy("b")).applyInArrow(
        score_block(totals), f"k {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    names = [key, *(fresh(n, [key]) for n in ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))]
    return out.select("k", "held_out", "n_tokens", "n_known", F.lit(totals["tokens"]).cast("long").alias("t"), "base_score", "score").toDF(*names)


@query()
def op1_ppm(spark, sf_dir):
    """Base and model log10 probability of every document, learnt from the rows that are not held out."""
    return score_documents(table(spark, sf_dir, "documents"), held_out("doc_id", 5, 1))
