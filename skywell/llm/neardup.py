"""Near-duplicate documents by Order MinHash.

A text is the sequence of its five-word shingles, each labelled with how often it occurred before,
so no two are equal. A sketch function orders them by a hash; the few least, kept in the order they have in
the text, make one signature. Texts whose signatures agree for some function share a bucket. Such a
pair is verified by aligning both sequences within the band that a similarity of 0.8 allows: similarity is
the length of the longest common chain over the shingles of both less that length.

Equal word sequences are one text from the start. In a bucket all texts are compared with a leader,
so a bucket that is one class costs no more than its size. What then still shares a bucket across classes is compared
in full, each pair once, until its classes are joined. Classes are the connected components.
"""

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skywell.llm.common import fresh, mixed, query, shingles, small_batches, table, word_hashes, written
from skywell.llm.components import components, sent_if_small

WORDS = 5
SIMILARITY = 0.8
FUNCTIONS, LEAST = 16, 4  # signatures of four shingles: a pair of similarity 0.8 shares one with probability 0.9998
SHORT, SHORT_FUNCTIONS, SHORT_LEAST = 20, 8, 2  # short texts get signatures of two shingles as well
COLUMNS = 1 << 14  # shingles ordered at a time
CELL = 256  # texts of a bucket compared in one task with as many others

_R = np.random.default_rng(6)
ORDERS = (_R.integers(0, 1 << 63, FUNCTIONS + SHORT_FUNCTIONS, np.uint64) << np.uint64(1)) | np.uint64(1)


def labelled(runs: np.ndarray) -> np.ndarray:
    """Shingle hashes made distinct by the number of earlier equal ones."""
    order = np.argsort(runs, kind="stable")
    ranked = runs[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(runs) else np.zeros(0, np.bool_)
    first = np.flatnonzero(new)
    earlier = np.empty(len(runs), np.uint64)
    earlier[order] = np.arange(len(runs)) - np.repeat(first, np.diff(np.concatenate((first, [len(runs)]))))
    return mixed(runs + earlier * np.uint64(0xA0761D6478BD642F))


def least_in_order(keys: np.ndarray, orders: np.ndarray, size: int) -> np.ndarray:
    """One signature per order: its `size` least keys, hashed in text order."""
    at, value = np.zeros((len(orders), 0), np.int64), np.zeros((len(orders), 0), np.uint64)
    for first in range(0, len(keys), COLUMNS):
        part = keys[first : first + COLUMNS]
        value = np.concatenate((value, part[None, :] * orders[:, None]), axis=1)
        at = np.concatenate((at, np.broadcast_to(np.arange(first, first + len(part)), (len(orders), len(part)))), axis=1)
        if value.shape[1] > size:
            best = np.argpartition(value, size - 1, axis=1)[:, :size]
            value, at = np.take_along_axis(value, best, 1), np.take_along_axis(at, best, 1)
    chosen = keys[np.sort(at, axis=1)]
    out = orders.copy()
    for i in range(chosen.shape[1]):
        out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + chosen[:, i])
    return out


def signatures(words: np.ndarray) -> np.ndarray:
    keys = labelled(shingles(words, WORDS))
    if not len(keys):
        return keys
    out = least_in_order(keys, ORDERS[:FUNCTIONS], LEAST)
    if len(keys) <= SHORT:
        out = np.concatenate((out, least_in_order(keys, ORDERS[FUNCTIONS:], SHORT_LEAST)))
    return out


def chain(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> int:
    """Length of the longest common chain of two labelled sequences within the band of `similarity`."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    needed = similarity / (1 + similarity) * (len(a) + len(b))
    inside = np.abs(i - j) <= max(len(a), len(b)) - needed
    order = np.argsort(i[inside])
    j = j[inside][order]
    if len(j) < needed - 1e-9 or bool((j[1:] > j[:-1]).all()):
        return len(j)
    ends: list[int] = []
    for x in j.tolist():
        k = bisect.bisect_left(ends, x)
        if k == len(ends):
            ends.append(x)
        else:
            ends[k] = x
    return len(ends)


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two word sequences; below the threshold it may come out too high, yet below it."""
    x, y = labelled(shingles(a, WORDS)), labelled(shingles(b, WORDS))
    n = chain(x, y)
    return n / max(len(x) + len(y) - n, 1)


def sketched(df: DataFrame, text: str, keep: tuple) -> DataFrame:
    """`keep`, `tid` (a digest of the words), `size` (shingles), `signatures` and `words` of every row, written.

    Words are kept as 16 bits of their hashes: shingles of five are still told apart by 80 bits.
    """
    small_batches(df.sparkSession)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(fresh("text_", keep)))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])

    def sketch(batches):
        for b in batches:
            words = [word_hashes(t) for t in b.column(b.num_columns - 1).to_pylist()]
            columns = (
                pa.array([hashlib.blake2b(w.tobytes(), digest_size=16).digest() for w in words], pa.binary()),
                pa.array([max(len(w) - WORDS + 1, min(len(w), 1)) for w in words], pa.int64()),
                pa.array([signatures(w).view(np.int64) for w in words], pa.list_(pa.int64())),
                pa.array([(w >> np.uint64(48)).astype("<u2").tobytes() for w in words], pa.binary()),
            )
            arrays = [b.column(i) for i in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*arrays, *columns], [*b.schema.names[:-1], "tid", "size", "signatures", "words"])

    return written(rows.mapInArrow(sketch, f"{fields}tid binary, size long, signatures array<long>, words binary"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs `a`, `b` of text digests that are similar enough, written.

    Only texts that are in a pair are shuffled, once per side; lengths that rule a pair out drop it before.
    """
    pairs = written(pairs.distinct())
    wanted = written(pairs.select(F.col("a").alias("tid")).union(pairs.select("b")).distinct())
    texts = texts.join(sent_if_small(wanted), "tid", "left_semi")
    texts = written(texts.groupBy("tid").agg(F.min("words").alias("words")))
    sides = [texts.select(F.col("tid").alias(c), F.col("words").alias(f"w_{c}")) for c in ("a", "b")]

    def align(batches):
        for b in batches:
            w = [[np.frombuffer(x, "<u2").astype(np.uint64) for x in b.column(c).to_pylist()] for c in ("w_a", "w_b")]
            good = [similarity_of(x, y) >= SIMILARITY for x, y in zip(*w)]
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "w_a", "w_b")
    return written(both.mapInArrow(align, "a binary, b binary"))


def led(buckets: DataFrame, keys: list[str], seeds: tuple = (), member: str = "tid") -> DataFrame:
    """`a`, `b`: each bucket's members with its leader, the first in the order of a hash of member and `seeds`.

    With one order for all buckets, those of a large class mostly have the same few leaders, so its members are in
    few pairs. Members without a bucket fellow, and pairs whose lengths rule them out, are left out.
    """
    order = F.struct(F.xxhash64(member, *seeds).alias("h"), F.col(member).alias("leader"), F.col("size").alias("leader_size"))
    heads = buckets.groupBy(*keys).agg(F.min(order).alias("head"), F.count("*").alias("n")).filter("n > 1")
    near = F.least("size", "leader_size") >= SIMILARITY * F.greatest("size", "leader_size")
    return (
        buckets.join(heads.select(*keys, "head.leader", "head.leader_size"), keys)
        .filter((F.col(member) != F.col("leader")) & near)
        .select(F.least(member, "leader").alias("a"), F.greatest(member, "leader").alias("b"))
    )


def classes(sketches: DataFrame) -> DataFrame:
    """`tid`, `label` of all texts that are similar to another one; equal labels are one class."""
    texts = sketches.filter("size > 0").select("tid", "words")
    one_each = sketches.filter("size > 0").select("tid", "size", "signatures").groupBy("tid").agg(
        F.min(F.struct("size", "signatures")).alias("x")
    )
    buckets = one_each.select("tid", "x.size", F.posexplode("x.signatures").alias("band", "sig"))
    shared = buckets.groupBy("band", "sig").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    buckets = written(buckets.join(shared, ["band", "sig"]))
    label = components(verified(led(buckets, ["band", "sig"]), texts)).withColumnRenamed("node", "tid")
    placed = written(buckets.join(label, "tid", "left").withColumn("label", F.coalesce("label", "tid")))
    merged = crossing(placed, one_each, texts)
    if merged.isEmpty():
        return label
    merged = components(merged).select(F.col("node").alias("label"), F.col("label").alias("whole"))
    members = written(placed.select("tid", "label").distinct())
    return members.join(merged, "label", "left").select("tid", F.coalesce("whole", "label").alias("label"))


def crossing(placed: DataFrame, one_each: DataFrame, texts: DataFrame) -> DataFrame:
    """`a`, `b`: labels to merge, of classes with a similar pair of texts in one bucket.

    Each such pair has a member outside the largest class of its bucket. Those members, in cells, meet all
    members of the bucket, in cells: what is sent grows with the members outside the largest class. A pair that
    shares several buckets is compared in the first. A cell names two classes once, however many pairs they have.
    """
    sizes = written(placed.groupBy("band", "sig", "label").agg(F.count("*").alias("n")))
    most = sizes.groupBy("band", "sig").agg(
        F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("all"), F.count("*").alias("labels")
    ).filter("labels > 1")
    cells = lambda n: F.ceil(n / CELL).cast("int")
    most = written(most.select(
        "band", "sig", F.col("most.label").alias("main"), cells(F.col("all") - F.col("most.n")).alias("few"), cells(F.col("all")).alias("many")
    ))
    mixed_up = written(placed.join(most, ["band", "sig"]))
    if mixed_up.isEmpty():
        return placed.sparkSession.createDataFrame([], "a binary, b binary")
    used = sent_if_small(written(mixed_up.select("tid").distinct()))
    words = texts.join(used, "tid", "left_semi").groupBy("tid").agg(F.min("words").alias("words"))
    known = written(words.join(one_each.select("tid", "x.signatures"), "tid"))
    rows = mixed_up.join(known, "tid").withColumn("main", F.col("label") == F.col("main"))
    at = F.xxhash64("tid", F.lit(6))
    left = rows.filter("not main").withColumn("i", F.pmod(at, F.col("few"))).withColumn("j", F.explode(F.expr("sequence(0, many - 1)")))
    right = rows.withColumn("j", F.pmod(at, F.col("many"))).withColumn("i", F.explode(F.expr("sequence(0, few - 1)")))
    cell = ["band", "sig", "i", "j"]
    columns = [*[F.col(c).cast("long").alias(c) for c in cell], "tid", "size", "label", "main", "signatures", "words"]
    left, right = left.select(*columns), right.select(*columns)
    asked = left.toDF(*[f"l_{c}" for c in left.columns])
    both = asked.groupBy(*[f"l_{c}" for c in cell]).cogroup(right.groupBy(*cell))
    return written(both.applyInArrow(compared, "a binary, b binary").distinct())


def compared(left: pa.Table, right: pa.Table) -> pa.Table:
    """Pairs of labels of similar texts, of a cell outside the largest class of a bucket and a cell of all its members.

    Labels that a pair has joined are one from then on, so no more of their texts are compared.
    """
    out = ([], [])
    if left.num_rows and right.num_rows:
        left = left.rename_columns([c.removeprefix("l_") for c in left.column_names])
        band = left.column("band")[0].as_py()
        names: dict = {}
        (ids, labels, signs), (others, other_labels, other_signs) = (
            (np.array(t.column("tid").to_pylist(), object), np.array([names.setdefault(x, len(names)) for x in t.column("label").to_pylist()]),
             [np.array(x, np.int64) for x in t.column("signatures").to_pylist()]) for t in (left, right)
        )
        spelled = list(names)
        width = max(map(len, (*signs, *other_signs)))
        filled = np.zeros((len(others), width), np.int64)
        there = np.zeros((len(others), width), np.bool_)
        for k, x in enumerate(other_signs):
            filled[k, : len(x)], there[k, : len(x)] = x, True
        size, other_size = (t.column("size").to_numpy().astype(float) for t in (left, right))
        main = right.column("main").to_numpy(zero_copy_only=False).astype(bool)
        keys, other_keys = (
            [labelled(shingles(np.frombuffer(x, "<u2").astype(np.uint64), WORDS)) for x in t.column("words").to_pylist()] for t in (left, right)
        )
        flat, place = np.unique(np.concatenate(other_keys), return_inverse=True)
        starts = np.concatenate(([0], np.cumsum([len(k) for k in other_keys])))[:-1]
        for i, x in enumerate(keys):
            near = np.minimum(size[i], other_size) >= SIMILARITY * np.maximum(size[i], other_size) - 1e-9
            near &= (other_labels != labels[i]) & (main | (others > ids[i]))
            n = min(len(signs[i]), band)
            near &= ~((filled[:, :n] == signs[i][:n]) & there[:, :n]).any(axis=1)  # compared in an earlier band
            if not near.any():
                continue
            in_x = np.isin(flat, x, assume_unique=True)
            shared = np.add.reduceat(in_x[place].astype(np.int64), starts)  # a chain is no longer than what both have
            near &= shared >= SIMILARITY / (1 + SIMILARITY) * (len(x) + other_size) - 1e-9
            for j in np.flatnonzero(near):
                if labels[i] == other_labels[j]:
                    continue
                y = other_keys[j]
                n = chain(x, y)
                if n >= SIMILARITY * (len(x) + len(y) - n):
                    one, two = labels[i], other_labels[j]
                    out[0].append(spelled[one])
                    out[1].append(spelled[two])
                    labels[labels == two], other_labels[other_labels == two] = one, one
    return pa.table([pa.array(x, pa.binary()) for x in out], ["a", "b"])


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Key, `class_id` (the class's least key) and `class_size` of every row.

    Rows with equal words are in one class. Texts without a word, null ones among them, are
    similar to nothing: each row is a class of its own, under its own key. Texts of fewer than five words
    are one shingle. Rows with null keys count; a class of only such rows has a null id. Repeated
    rows repeat; other columns are not read.
    """
    rows = sketched(df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")), "t", ("k",))
    labels = classes(rows)
    placed = rows.select("k", "tid", "size").join(labels, "tid", "left").withColumn("label", F.coalesce("label", "tid"))
    placed = written(placed.select("k", "label", "size"))
    sums = placed.filter("size > 0").groupBy("label").agg(F.min("k").alias("class_id"), F.count("*").alias("class_size"))
    grouped = placed.filter("size > 0").join(sums, "label").select("k", "class_id", "class_size")
    alone = placed.filter("size = 0").select("k", F.col("k").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    names = [key, fresh("class_id", [key]), fresh("class_size", [key])]
    return grouped.unionByName(alone).toDF(*names)


def deduplicated(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `df` with one left of each class: that with the least key, null keys last.

    The same classes as `near_duplicates`; the rows are written once, so that each has a number
    that tells repeated rows apart.
    """
    number = fresh("row_", df.columns)
    rows = written(df.withColumn(number, F.monotonically_increasing_id()))
    sketches = sketched(rows.select(F.col(number).alias("r"), F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")), "t", ("r", "k"))
    labels = classes(sketches)
    placed = sketches.filter("size > 0").select("r", "k", "tid").join(labels, "tid", "left").withColumn("label", F.coalesce("label", "tid"))
    placed = written(placed.select("r", "k", "label"))
    first = placed.groupBy("label").agg(F.min(F.struct(F.col("k").isNull().alias("no_key"), "k", "r")).alias("first"))
    left = placed.join(first, "label").filter("r <> first.r").select(F.col("r").alias(number))
    return rows.join(sent_if_small(written(left)), number, "left_anti").select(*df.columns)


@query()
def op6_neardup(spark, sf_dir):
    """The class of near-duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
