"""Best-two-fit packing: ids against the tokenizer itself, an exact round trip, fills against the least possible."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skywell.llm import bestfit
from tests.compare import database

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "a", "Don't  STOP now, it's 3.14%", "<|endoftext|> x <|startoftext|>y", "a\n\nb", "a \nb", "a\n b", "\tx\ty", " lead",
    "trail ", "trail\n", "\nlead", "日本語 テスト 🙂🙂 x", "a b c d  e", "x\x0b y", "a\u0085 b", "e\x1c d", "'s 't''re ''''",
    "word " * 3000, "x" * 5000, "a\r\nb", "don’t — “q”", "aĠb Ċ c", "Ends, here: yes!? no.", "ˮ, x" "é́, ß; ŉ: ǅ.",
]


def test_ids_are_the_tokenizers():
    plain = Tokenizer.from_file(PATH)
    texts = ODD + [r[0] for r in database("/root/testdata/sf0.001").execute("select text from documents").fetchall()]
    ids = bestfit.ChunkIds(PATH)
    for part in (texts[:7], texts[7:], texts):  # known chunks and new ones
        for t, g in zip(part, ids(pa.array(part), 0)):
            assert g.tolist() == plain.encode(t or "", add_special_tokens=False).ids + [0], t
    assert ids(pa.array([], pa.string()), 0) == []


def greedy_bins(sizes, capacity):
    """Greedy filling with the exchange of the smallest, by trying all items and pairs."""
    left, out = sorted(sizes, reverse=True), []
    while left:
        held, room = [], capacity
        while any(n <= room for n in left):
            n = next(n for n in left if n <= room)
            left.remove(n)
            held.append(n)
            room -= n
        while room:
            small = min(held)
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if small < a + b <= room + small]
            if not pairs:
                break
            best, a, b = max(pairs)
            held.remove(small)
            left.remove(a)
            left.remove(b)
            held += [a, b]
            left = sorted([*left, small], reverse=True)
            room += small - best
        out.append(sum(held))
    return out


def test_fills_equal_brute_force():
    r = random.Random(3)
    for _ in range(150):
        sizes = [r.randint(1, r.choice([10, 40, 60])) for _ in range(r.randint(0, 40))]
        bins = bestfit.best_two_fit(sizes, 60)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert [sum(sizes[i] for i in b) for b in bins] == greedy_bins(sizes, 60)


def test_pairs_fill_gaps_a_single_piece_leaves():
    assert len(bestfit.best_two_fit([60, 30, 25, 15, 70], 100)) == 2  # 70 + 30, 60 + 25 + 15
    assert len(bestfit.best_two_fit([50, 40, 28, 22, 60], 100)) == 2  # 60 + 40, 50 + 28 + 22


def check(rows, texts, capacity):
    plain = Tokenizer.from_file(PATH)
    fills, by = defaultdict(list), defaultdict(list)
    for r in rows:
        fills[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id].append(r)
    for parts in fills.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= capacity
    assert set(by) == set(texts)
    total = 0
    for k, ts in texts.items():
        want = [plain.encode(t or "", add_special_tokens=False).ids + [0] for t in ts]
        total += sum(map(len, want))
        assert len(by[k]) == sum(-(-len(w) // capacity) for w in want)
        assert sum(r.length for r in by[k]) == sum(map(len, want))
        if len(ts) == 1:
            parts = sorted(by[k], key=lambda r: r.piece)
            assert [r.piece for r in parts] == list(range(len(parts))) and all(r.length == capacity for r in parts[1:])
            assert [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
            assert np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist() == want[0]
    return len(fills), -(-total // capacity)


@pytest.mark.parametrize("capacity, group", [(2048, 8192), (16, 3)])
def test_round_trip(spark, capacity, group):
    rows = [(i, t, 0) for i, t in enumerate(ODD)] + [(None, "null key", 0)] + [(99, "same row", 0)] * 6
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    texts = defaultdict(list)
    for k, t, _ in rows:
        texts[k].append(t)
    check(bestfit.pack_whole(df, capacity=capacity, group=group).collect(), texts, capacity)
    assert bestfit.pack_whole(df.limit(0)).count() == 0
    clash = df.select(df.doc_id.alias("piece"), df.text.alias("ids"))
    assert bestfit.pack_whole(clash, "ids", "piece").columns[0] == "piece"


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {k: [t] for k, t in database(sf).execute("select doc_id, text from documents").fetchall()}
    pieces = bestfit.pack_whole(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    used, least = check(pieces, texts, 2048)
    assert used <= least + 1
    got = {(r.doc_id, r.piece): r for r in bestfit.op12_bestfit(spark, sf).collect()}
    assert all(got[r.doc_id, r.piece].ids_crc32 == zlib.crc32(bytes(r.ids)) for r in pieces) and len(got) == len(pieces)


def test_a_known_chunk_is_looked_up_once():
    """Most of a batch's chunks are known; each of them costs one look."""
    looks = []

    class Counted(dict):
        def get(self, *a):
            looks.append(a[0])
            return super().get(*a)

        def __contains__(self, k):
            looks.append(k)
            return super().__contains__(k)

        def __getitem__(self, k):
            looks.append(k)
            return super().__getitem__(k)

    ids_of = bestfit.ChunkIds(public_tokenizers.path("byte_bpe_50k.json"))
    texts = pa.array(["one two three, one two", None, "two one\nthree", " odd  spaces "])
    first = ids_of(texts, 0)
    ids_of.known = Counted(ids_of.known)
    again = ids_of(texts, 0)
    assert [x.tolist() for x in again] == [x.tolist() for x in first]
    assert len(looks) == len(set(looks)) > 0
