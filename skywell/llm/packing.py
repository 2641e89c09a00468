"""Packing token sequences: first-fit decreasing in randomised groups of documents.

Documents are tokenized where they are read. A document's full windows become sequences of their
own; the rest of each document is placed, longest first, into the first open sequence with room, which
a tournament tree over the free places finds in logarithmic time. Sequences that end with room are
then topped up with the end of pieces from the emptiest ones, so a group leaves at most one
sequence unfilled, which is written as sequences of powers of two that need no padding.
"""

import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, pre_tokenizers

from skywell.llm.common import fresh, query, small_batches, table, together

CAPACITY = 2048
END = 1
GROUP = 2048  # documents of a group, about
STOPS = [".", ",", ";", ":", "!", "?"]
MARKED = r"^(?P<stem>\p{L}+)(?P<mark>[-!\"#$%&()*+,./:;=?@\[\\\]^_`{}~]+)$"  # one part each
LETTERS = r"^[a-zÀ-ÖØ-öø-ÿа-яё\x{4E00}-\x{9FFF}]+$"  # letters that normalising leaves or only makes lower case
BLOCK = 1024  # words tokenized together
CACHED = 150_000  # words whose ids a worker remembers


class WordIds:
    """Ids of texts, word by word: white space ends every token of this vocabulary.

    Words met are kept as one array, their ids end to end in another, so a batch of texts is looked up
    and put together by array operations; only new words reach the tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here
        self.tokenizer = Tokenizer.from_file(path)
        # for runs of plain lower-case letters, which the full rules leave as they are
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.last = np.zeros(size, np.bool_)  # tokens that end a part of a word
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.last[i] = token.endswith("</w>")
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.words, self.ids, self.bounds = pa.array([], pa.string()), np.zeros(0, self.kind), np.zeros(1, np.int64)
        self.met = np.zeros(0, np.bool_)  # words met in more than one batch
        self.add(pa.array(STOPS), *self.encoded(pa.array(STOPS)))

    def add(self, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.concatenate((self.ids, ids))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(lengths)))
        self.met = np.concatenate((self.met, np.zeros(len(words), np.bool_)))

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at the positions `at`, end to end, and how many each has."""
        lengths = np.diff(self.bounds)[at]
        stops = np.cumsum(lengths)
        total = int(stops[-1]) if len(stops) else 0
        return self.ids[np.repeat(self.bounds[at] - (stops - lengths), lengths) + np.arange(total)], lengths

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of words one by one."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return np.array([i for ids in got for i in ids], self.kind), np.array([len(ids) for ids in got], np.int64)

    def learn(self, words: pa.Array) -> np.ndarray:
        """Add unknown words and give their positions: letters with a mark after them by their parts,
        letters together, others one by one."""
        marked = pc.match_substring_regex(words, MARKED)
        ended = words.filter(marked)
        pieces = pc.extract_regex(ended, MARKED)
        parts = pa.concat_arrays([pc.struct_field(pieces, "stem"), pc.struct_field(pieces, "mark")])
        known = pc.index_in(parts, self.words)
        fresh_parts = pc.unique(pa.concat_arrays([words.filter(pc.invert(marked)), parts.filter(pc.is_null(known))]))
        run = pc.match_substring_regex(fresh_parts, LETTERS)
        letters, other = fresh_parts.filter(run), fresh_parts.filter(pc.invert(run))
        blocks = pa.ListArray.from_arrays(pa.array([*range(0, len(letters), BLOCK), len(letters)], pa.int32()), pc.utf8_lower(letters))
        texts = pc.binary_join(blocks, " ").to_pylist()
        got = [np.array(e.ids, self.kind) for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, self.kind), *got])
        lengths = np.diff(np.concatenate(([0], np.flatnonzero(self.last[ids]) + 1)))  # a run of letters has one last token
        size = len(self.words)
        if len(lengths) == len(letters) and lengths.sum() == len(ids):
            self.add(letters, ids, lengths)
        else:
            self.add(letters, *self.encoded(letters))
        self.add(other, *self.encoded(other))
        at = pc.coalesce(known, pc.add(pc.index_in(parts, self.words[size:]), size)).to_numpy()
        ids, lengths = self.gathered(at.reshape(2, -1).T.ravel())
        self.add(ended, ids, lengths[::2] + lengths[1::2])
        return pc.index_in(words, self.words[size:]).to_numpy() + size

    def __call__(self, texts: pa.Array, end: int | None = None) -> pa.Array:
        """The ids of each text as little-endian bytes, `end` after them; a null text has no words."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        special = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring(texts, "|>"))
        words = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        coded = words.flatten().dictionary_encode()
        unique, at = coded.dictionary, coded.indices.to_numpy()
        if len(self.words) > CACHED:
            self.met[: len(STOPS)] = True
            ids, lengths = self.gathered(np.flatnonzero(self.met))
            kept = self.words.filter(pa.array(self.met))
            self.words, self.ids, self.bounds, self.met = kept[:0], ids[:0], self.bounds[:1], self.met[:0]
            self.add(kept, ids, lengths)
        place = pc.index_in(unique, self.words)
        self.met[place.drop_null().to_numpy()] = True
        new = unique.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).copy()
        if len(new):
            place[place < 0] = self.learn(new)
        at = place[at]
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        ids, lengths = self.gathered(at)
        stops = np.concatenate(([0], np.cumsum(lengths)))[bounds]
        if end is not None:
            ids = np.insert(ids, stops[1:], end)
            stops = stops + np.arange(len(stops))
        offsets = (stops * self.kind.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


WORD_IDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per worker process, kept between tasks."""
    if path not in WORD_IDS:
        WORD_IDS[path] = WordIds(path)
    return WORD_IDS[path]


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; `sizes` come in decreasing order, each at most `capacity`."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    tree = [capacity] * (2 * leaves)  # tree[i]: the largest room below node i
    out = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        out.append(node - leaves)
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return out


def topped_up(bins: list[list[list[int]]], capacity: int) -> list[list[list[int]]]:
    """Fill the fuller bins with the ends of pieces of the emptier; pieces are `[doc, start, length]`.

    What a single unfilled bin holds in the end is split into bins of powers of two.
    """
    bins = sorted(bins, key=lambda b: -sum(p[2] for p in b))
    room = [capacity - sum(p[2] for p in b) for b in bins]
    i, j = 0, len(bins) - 1
    while i < j:
        if room[i] == 0:
            i += 1
        elif not bins[j]:
            j -= 1
        else:
            piece = bins[j][-1]
            n = min(room[i], piece[2])
            bins[i].append([piece[0], piece[1] + piece[2] - n, n])
            room[i] -= n
            piece[2] -= n
            if not piece[2]:
                bins[j].pop()
    full, rest = [b for k, b in enumerate(bins) if b and room[k] == 0], [b for k, b in enumerate(bins) if b and room[k]]
    for b in rest:
        left = sum(p[2] for p in b)
        while left:
            take = 1 << (left.bit_length() - 1)
            left -= take
            part = []
            while take:
                piece = b[0]
                n = min(take, piece[2])
                part.append([piece[0], piece[1], n])
                piece[1] += n
                piece[2] -= n
                take -= n
                if not piece[2]:
                    b.pop(0)
            full.append(part)
    return full


def packed(lengths: list[int], capacity: int) -> list[list[list[int]]]:
    """Sequences of pieces `[doc, start, length]` that hold all documents of a group."""
    whole = [[[d, s, capacity]] for d, n in enumerate(lengths) for s in range(0, n - capacity + 1, capacity)]
    rest = [[d, n - n % capacity, n % capacity] for d, n in enumerate(lengths) if n % capacity]
    rest.sort(key=lambda p: -p[2])
    bins: dict[int, list] = {}
    for piece, b in zip(rest, first_fit_decreasing([p[2] for p in rest], capacity)):
        bins.setdefault(b, []).append(piece)
    return whole + topped_up(list(bins.values()), capacity)


def pack(
    df: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, group: int = GROUP,
    vocabulary: str | None = None, end: int = END, seed: int = 5,
) -> DataFrame:
    """Pieces of all documents: key, `start`, `length`, `ids` (little-endian unsigned 32-bit),
    `doc_tokens`, `sequence_id` and `offset` in the sequence.

    Null texts are empty documents of one id. Repeated rows are documents of their own (they share
    their key, and the starts of each begin at 0). Groups are dealt by a hash of the key and of the
    partition read, so a key that many rows share still spreads. An empty table has no piece;
    other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    kind = dict(df.dtypes)[key]
    groups = -(-max(df.count(), 1) // group)
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).withColumn(
        "g", F.pmod(F.xxhash64("k", F.spark_partition_id(), F.lit(seed)), F.lit(groups)).cast("long")
    )

    def tokenize(batches):
        ids = word_ids(path)
        for b in together(batches, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), ids(b.column(1), end)], ["k", "g", "ids"])

    names = [key, *(fresh(n, [key]) for n in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset"))]

    def place(part: pa.Table) -> pa.Table:
        from_kind = word_ids(path).kind
        keys, raw = part.column("k").to_pylist(), part.column("ids").to_pylist()
        order = sorted(range(len(raw)), key=lambda i: (keys[i] is None, keys[i] or 0, raw[i]))
        ids = [np.frombuffer(raw[i], from_kind) for i in order]
        base = part.column("g")[0].as_py() << 32
        columns = [[] for _ in range(6)]
        at = []
        for s, pieces in enumerate(packed([len(x) for x in ids], capacity)):
            offset = 0
            for d, start, n in pieces:
                row = (start, n, ids[d][start : start + n].astype("<u4").tobytes(), len(ids[d]), base + s, offset)
                at.append(order[d])
                offset += n
                for c, v in zip(columns, row):
                    c.append(v)
        made = [pa.array(c, pa.binary() if i == 2 else pa.int64()) for i, c in enumerate(columns)]
        return pa.table([part.column("k").take(pa.array(at, pa.int64())), *made], names)

    out = f"`{key}` {kind}, {names[1]} long, {names[2]} long, {names[3]} binary, " + ", ".join(f"{n} long" for n in names[4:])
    return rows.mapInArrow(tokenize, f"k {kind}, g long, ids binary").groupBy("g").applyInArrow(place, out)


@query()
def op5_packing(spark, sf_dir):
    """Where every piece of every document stands, with a checksum of its ids."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
