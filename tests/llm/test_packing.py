"""Packing: ids against the tokenizer itself, an exact round trip, first fit against brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from skywell.llm import packing
from tests.compare import database

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "a", "Don't STOP now, it's 3.14%", "<|endoftext|> x <|startoftext|>y", "İstanbul ΣΑΣ ß ŉ", "é ́x ẛ̣",
    "a b c\u0085d\x1ce", "日本語 テスト 🙂🙂 x", "tab\tnew\nline\r\nff\x0c", "'s 't''re ''''", "word " * 5000, "x" * 3000,
    "a​b ﻿ z", "ﬁne ½ ² Ⅷ", "don’t — “q”",
]


def test_word_ids_are_the_tokenizers():
    plain = Tokenizer.from_file(PATH)
    texts = ODD + [r[0] for r in database("/root/testdata/sf0.001").execute("select text from documents").fetchall()]
    got = packing.WordIds(PATH)(pa.array(texts)).to_pylist()
    for t, g in zip(texts, got):
        assert np.frombuffer(g, "<u2").tolist() == plain.encode(t or "", add_special_tokens=False).ids, t


def test_first_fit_equals_brute_force():
    r = random.Random(1)
    for _ in range(200):
        sizes = sorted((r.randint(1, 50) for _ in range(r.randint(0, 60))), reverse=True)
        room, want = [], []
        for s in sizes:
            b = next((i for i, x in enumerate(room) if x >= s), len(room))
            if b == len(room):
                room.append(50)
            room[b] -= s
            want.append(b)
        assert packing.first_fit_decreasing(sizes, 50) == want


def check(rows, texts, capacity):
    """`rows` of pieces hold the ids of `texts` (key: list of texts) exactly once."""
    plain = Tokenizer.from_file(PATH)
    fills = defaultdict(list)
    by = defaultdict(list)
    for r in rows:
        fills[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id].append(r)
    for parts in fills.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == capacity or at & (at - 1) == 0
    assert set(by) == set(texts)
    for k, ts in texts.items():
        want = sorted(plain.encode(t or "", add_special_tokens=False).ids + [1] for t in ts)
        if len(ts) == 1:
            parts = sorted(by[k], key=lambda r: r.start)
            assert np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist() == want[0]
            assert [r.start for r in parts] == np.cumsum([0] + [r.length for r in parts])[:-1].tolist()
        assert sum(r.length for r in by[k]) == sum(map(len, want))
        assert {r.doc_tokens for r in by[k]} == {len(w) for w in want}


@pytest.mark.parametrize("capacity, group", [(2048, 2048), (16, 3)])
def test_round_trip(spark, capacity, group):
    rows = [(i, t, 0) for i, t in enumerate(ODD)] + [(None, "null key", 0)] + [(99, "same row", 0)] * 6
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    texts = defaultdict(list)
    for k, t, _ in rows:
        texts[k].append(t)
    check(packing.pack(df, capacity=capacity, group=group).collect(), texts, capacity)
    assert packing.pack(df.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {k: [t] for k, t in database(sf).execute("select doc_id, text from documents").fetchall()}
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    check(pieces, texts, 2048)
    got = {(r.doc_id, r.start): r for r in packing.op5_packing(spark, sf).collect()}
    assert all(got[r.doc_id, r.start].ids_crc32 == zlib.crc32(bytes(r.ids)) for r in pieces) and len(got) == len(pieces)
