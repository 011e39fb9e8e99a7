"""Packing: ids against the tokenizer, round trips, and no overlap or gap in any sequence."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from regulink.llm import packing as pk

PATH = public_tokenizers.path(pk.TOKENIZER)


def test_ids_equal_the_tokenizer():
    dealt = random.Random(5)
    letters = [*"abS' ▁\n\t\r<>/s.,! é①🙂ﬁ\u3000\u00a0\x00\x1c中éIİ1٣Σß×", "<|endoftext|>", "'s", "\u0301"]
    texts = ["", "<|startoftext|> x", "It's", "ÀÉ à"] + [
        "".join(dealt.choice(letters) for _ in range(dealt.randrange(20))) for _ in range(3000)
    ]
    said = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    assert pk.PreTokenIds(PATH).encode(texts) == [np.array(s.ids, "<u4").tobytes() for s in said]


@pytest.mark.parametrize("seed", range(4))
def test_runs_use_each_length_once(seed):
    dealt = np.random.default_rng(seed)
    lengths = np.minimum(64, dealt.geometric(0.05, 4000) + dealt.integers(0, 3, 4000))
    counts = np.bincount(lengths, minlength=65)
    runs = pk.pack_histogram(counts)
    used = np.zeros(65, int)
    for pattern, n in runs:
        assert n > 0 and sum(pattern) <= 64
        np.add.at(used, list(pattern), n)
    assert used.tolist() == counts.tolist()
    assert sum(n for _, n in runs) <= -(-lengths.sum() // 64) * 1.01 + 1


def test_fit_is_near_the_histogram():
    counts = np.zeros(11, int)
    counts[[3, 4, 5, 7, 6]] = [30, 20, 40, 30, 20]
    patterns = pk.enumerate_patterns(counts)
    assert (7, 3) in patterns and (6, 4) in patterns and (5, 5) in patterns and (4, 3, 3) in patterns
    repeats = dict(zip(patterns, pk.fit_repeats(patterns, counts), strict=True))
    assert repeats[7, 3] + repeats[6, 4] + repeats[5, 5] > 65


def check(rows, texts, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    by_sequence, pieces = defaultdict(list), defaultdict(int)
    for r in rows:
        ids = tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [0]
        assert r["start"] == r["piece"] * capacity and 0 < r["length"] <= capacity
        part = ids[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        pieces[r["doc_id"]] += r["length"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        assert pieces[doc_id] == len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence), sum(pieces.values())


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(pk, "BUCKET_ROWS", 7)  # several buckets for one length
    dealt = random.Random(1)
    texts = {k: " ".join(dealt.choice(["the", "of", "tokens", "x9"]) for _ in range(dealt.randrange(90))) for k in range(300)}
    texts |= {k: "same words here" for k in range(300, 420)} | {420: None, 421: "", 422: "word " * 500}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumnRenamed("text", "t")
    rows = pk.pack_documents(df.selectExpr("doc_id", "t as text", "t as offset"), PATH, capacity=64).collect()
    sequences, total = check(rows, texts, 64)
    assert sequences <= 1.02 * total / 64 + 1


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert pk.pack_documents(df, PATH).count() == 3
    assert pk.pack_documents(df.limit(0), PATH).count() == 0
