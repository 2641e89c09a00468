"""Best-two-fit packing: whole documents in as few sequences as it can.

Documents are tokenized where they are read. What is longer than a sequence is cut into full windows, which are
sequences of their own and go straight to the result, and a shorter first piece. Pieces and short documents are dealt at random to
groups of a bounded number. In a group a sequence is filled greedily, the largest piece that fits first. If it has room left, its
smallest piece is exchanged for two unpacked ones that fill the gap it leaves more tightly, until no exchange does.
"""

import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from skywell.llm.common import fresh, query, small_batches, table, together, written

CAPACITY = 2048
END = 0
GROUP = 8192  # pieces of a group, about: at most 4 kB each
CACHED = 800_000  # chunks whose ids a worker remembers
JOINED = 512  # chunks tokenized together
MARKED = re.compile(r"([ \n][A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]+)")  # letters and marks, which share no token
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: Spaces and line ends beside other white space, or at an end of the text: there a chunk's ids depend on its neighbours.
UNEVEN = rf"{SPACE}[ \n]|[ \n]{SPACE}|^{SPACE}|{SPACE}$|<\|"


class ChunkIds:
    """Ids of texts by chunks: a byte-level vocabulary starts a token at every single space or line end between words.

    The ids of the chunks met are kept end to end, so a batch of texts is put together by array operations; only new
    chunks reach the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.first = np.zeros(size, np.bool_)  # tokens that start with a space or line end
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.first[i] = token[:1] in ("Ġ", "Ċ")
        self.forget()

    def forget(self) -> None:
        self.known, self.ids, self.bounds = {}, np.zeros(0, self.kind), np.zeros(1, np.int64)

    def encoded(self, texts: list) -> list:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def add(self, chunks: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.known.update(zip(chunks, range(len(self.known), len(self.known) + len(chunks))))
        self.ids = np.concatenate((self.ids, ids))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(lengths)))

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks `at`, end to end, and how many each has."""
        lengths = np.diff(self.bounds)[at]
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        return self.ids[np.repeat(self.bounds[:-1][at] - stops + lengths, lengths) + np.arange(total)], lengths

    def learn(self, chunks: list) -> None:
        """Add unknown chunks: letters with marks after them by their parts, the others many at a time."""
        parts = {c: m.groups() for c in chunks if (m := MARKED.fullmatch(c))}
        plain = [c for c in chunks if c not in parts]
        plain += [p for p in dict.fromkeys(p for both in parts.values() for p in both) if p not in self.known]
        plain = list(dict.fromkeys(plain))
        led = [c for c in plain if c[:1] in (" ", "\n")]
        got = self.encoded(["".join(led[i : i + JOINED]) for i in range(0, len(led), JOINED)])
        ids = np.concatenate([np.zeros(0, self.kind), *got])
        lengths = np.diff(np.append(np.flatnonzero(self.first[ids]), len(ids)))
        if len(lengths) == len(led):
            self.add(led, ids, lengths)
        else:  # a chunk holds white space that its tokens start with
            self.one_by_one(led)
        self.one_by_one([c for c in plain if c[:1] not in (" ", "\n")])
        ids, lengths = self.gathered(np.array([self.known[p] for both in parts.values() for p in both], np.int64))
        self.add(list(parts), ids, lengths[::2] + lengths[1::2])

    def one_by_one(self, chunks: list) -> None:
        got = self.encoded(chunks)
        self.add(chunks, np.concatenate([np.zeros(0, self.kind), *got]), np.array([len(x) for x in got], np.int64))

    def __call__(self, texts: pa.Array, end: int) -> list:
        """The ids of each text with `end` after them, as arrays; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        uneven = pc.match_substring_regex(texts, UNEVEN)
        split = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(uneven)), "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        at, bounds = coded.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()
        begins = np.zeros(len(at) + 1, np.bool_)
        begins[bounds[:-1]] = True
        unique = coded.dictionary
        inner = pc.if_else(pc.starts_with(unique, "\n"), unique, pc.binary_join_element_wise("", unique, " "))
        names = pa.concat_arrays([unique, inner])  # as the start of a text, and within
        at = at + np.where(begins[:-1], 0, len(unique))
        seen = np.zeros(len(names), np.bool_)
        seen[at] = True
        used = np.flatnonzero(seen)
        wanted = names.take(pa.array(used))
        if len(self.known) > CACHED:
            self.forget()
        wanted = wanted.to_numpy(zero_copy_only=False).tolist()
        place = self.known.get
        found = np.fromiter((place(c, -1) for c in wanted), np.int64, len(wanted))
        if len(missing := np.flatnonzero(found < 0)):
            new = [wanted[i] for i in missing.tolist()]
            self.learn(new)
            found[missing] = [self.known[c] for c in new]
        where = np.zeros(len(names), np.int64)
        where[used] = found
        ids, lengths = self.gathered(where[at])
        stops = np.concatenate(([0], np.cumsum(lengths)))
        even = iter(np.split(ids, stops[bounds[1:-1]]) if len(bounds) > 1 else [])
        odd = iter(self.encoded(texts.filter(uneven).to_pylist()))
        last = np.array([end], self.kind)
        return [np.concatenate((next(odd if u else even), last)) for u in uneven.to_pylist()]


CHUNK_IDS: dict[str, ChunkIds] = {}


def chunk_ids(path: str) -> ChunkIds:
    """One per worker process, kept between tasks."""
    if path not in CHUNK_IDS:
        CHUNK_IDS[path] = ChunkIds(path)
    return CHUNK_IDS[path]


class Stock:
    """Unpacked items by size; the sizes that are left are the bits of one number."""

    def __init__(self, sizes: list[int]):
        self.items: dict[int, list[int]] = {}
        for i, n in enumerate(sizes):
            self.items.setdefault(n, []).append(i)
        self.left = sum(1 << n for n in self.items)

    def below(self, most: int) -> int:
        """The largest size of at most `most` that is left, or -1."""
        return (self.left & ((2 << most) - 1)).bit_length() - 1 if most > 0 else -1

    def take(self, size: int) -> int:
        items = self.items[size]
        item = items.pop()
        if not items:
            self.left ^= 1 << size
        return item

    def put(self, size: int, item: int) -> None:
        self.items[size].append(item)
        self.left |= 1 << size

    def two(self, room: int, above: int) -> tuple[int, int] | None:
        """The two sizes that fill `room` most tightly, with more than `above` together; the larger comes first."""
        best, found = above, None
        a = self.below(room)
        while a > 0 and 2 * a > best:
            rest = min(room - a, a)
            b = self.below(rest)
            if b == a and len(self.items[a]) < 2:
                b = self.below(a - 1)
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == room:
                    break
            a = self.below(a - 1)
        return found


def best_two_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """The items of each sequence; every size is from 1 to `capacity`."""
    stock, out = Stock(sizes), []
    while stock.left:
        held, room = [], capacity  # sizes fall, so the smallest comes last
        while (n := stock.below(room)) > 0:
            held.append((n, stock.take(n)))
            room -= n
        while room and stock.left:
            small, item = held[-1]
            pair = stock.two(room + small, small)
            if pair is None:
                break
            held.pop()
            held += [(n, stock.take(n)) for n in pair]
            stock_room = room + small - sum(pair)
            stock.put(small, item)
            held.sort(key=lambda x: -x[0])
            room = stock_room
        out.append([item for _, item in held])
    return out


def pack_whole(
    df: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, group: int = GROUP, vocabulary: str | None = None,
    end: int = END, seed: int = 12,
) -> DataFrame:
    """Pieces of all documents: key, `piece`, `start`, `length`, `ids` (little-endian unsigned 32-bit), `sequence_id` and `offset` in the sequence.

    Only documents longer than `capacity` are cut; their first piece may be shorter. Null texts are empty documents of one id.
    Repeated rows are documents of their own, and spread over the groups like any others: groups are dealt by a hash of where
    a row lies. An empty table has no piece; other columns are not read. A group leaves at most about one sequence partly filled
    that fuller groups would have used.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    kind = dict(df.dtypes)[key]
    groups = -(-max(df.count(), 1) // group)
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))

    def tokenize(batches):
        ids_of, part, row, full = chunk_ids(path), TaskContext.get().partitionId(), 0, 0
        for b in together(batches, 1):
            made = [[] for _ in range(6)]
            for i, ids in enumerate(ids_of(b.column(1), end)):
                head = len(ids) % capacity
                cuts = [0, *range(head or capacity, len(ids) + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                    whole = stop - start == capacity
                    full += whole
                    sequence = -(part << 40) - full if whole else row
                    values = (i, piece, start, stop - start, ids[start:stop].astype("<u4" if whole else ids.dtype).tobytes(), sequence)
                    for c, v in zip(made, values):
                        c.append(v)
                row += 1
            columns = [b.column(0).take(pa.array(made[0], pa.int64())), pa.array(made[1], pa.int32()), *(pa.array(c, pa.int64()) for c in made[2:4])]
            columns += [pa.array(made[4], pa.binary()), pa.array(np.full(len(made[0]), part, np.int32)), pa.array(made[5], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["k", "piece", "start", "length", "ids", "part", "number"])

    pieces = written(rows.mapInArrow(tokenize, f"k {kind}, piece int, start long, length long, ids binary, part int, number long"))
    names = [key, *(fresh(n, [key]) for n in ("piece", "start", "length", "ids", "sequence_id", "offset"))]
    fields = f"`{key}` {kind}, {names[1]} int, {names[2]} long, {names[3]} long, {names[4]} binary, {names[5]} long, {names[6]} long"
    whole = pieces.filter(F.col("length") == capacity).select("k", "piece", "start", "length", "ids", "number", F.lit(0).cast("long")).toDF(*names)
    dealt = pieces.filter(F.col("length") < capacity).withColumn("g", F.pmod(F.xxhash64("part", "number", F.lit(seed)), F.lit(groups)).cast("long"))

    def place(part: pa.Table) -> pa.Table:
        from_kind = chunk_ids(path).kind
        part = part.sort_by([("part", "ascending"), ("number", "ascending")])
        sizes = part.column("length").to_pylist()
        bins = best_two_fit(sizes, capacity)
        at = np.array([i for b in bins for i in b], np.int64)
        sequence = np.repeat(np.arange(len(bins)), [len(b) for b in bins]) + (part.column("g")[0].as_py() << 32)
        offset = [x for b in bins for x in np.cumsum([0, *(sizes[i] for i in b[:-1])]).tolist()]
        out = part.select(["k", "piece", "start", "length", "ids"]).take(pa.array(at))
        ids = pa.array([np.frombuffer(x, from_kind).astype("<u4").tobytes() for x in out.column("ids").to_pylist()], pa.binary())
        return pa.table([*out.columns[:4], ids, pa.array(sequence), pa.array(offset, pa.int64())], names)

    return whole.union(dealt.groupBy("g").applyInArrow(place, fields))


@query()
def op12_bestfit(spark, sf_dir):
    """Where every piece of every document stands, with a checksum of its ids."""
    return pack_whole(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
