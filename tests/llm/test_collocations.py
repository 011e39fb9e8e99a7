"""Collocations against plain counting of every phrase."""

import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from regulink.llm import collocations as co
from conftest import rows

SCHEMA = "doc_id long, lang string, text string, phrase string, w1 int"


def brute_force(given, most_words, least, top, inside):
    f, n = Counter(), Counter()
    for _, lang, text, *_ in given:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, most_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= least}
    found = {}
    for (lang, phrase), a in candidates.items():
        holders = [
            b
            for (other, longer), b in candidates.items()
            if other == lang and len(longer) > len(phrase) and 100 * b >= inside * a
            and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
        ]
        if holders:
            continue
        cuts = []
        for k in range(1, len(phrase)):
            left, right = f[lang, phrase[:k]], f[lang, phrase[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right))
    result = []
    for lang, all_of in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(all_of)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def corpus(seed):
    dealt = random.Random(seed)
    vocabulary = [w + str(k) for k, w in enumerate(["a", "É", "ü", "B", "x_y", "w\x00", "日本", "z'"] * 3)]
    phrase = ["New", "york", "City"]
    given = []
    for k in range(80):
        words = []
        for _ in range(dealt.choice([0, 1, 2, 5, 40])):
            words += dealt.choice([phrase, [dealt.choice(vocabulary)], [dealt.choice(vocabulary[:4])] * 2])
        text = "".join(w + dealt.choice([" ", "\t ", " ", " ", ". ", ",", "\n", "!?", "\x0b"]) for w in words)
        given.append((k, dealt.choice(["en", "en", "de", None]), text, "x", 7))
    return given + [(None, "en", None, None, None), (1, "en", "", None, None), (1, "fr", "  \t . ", None, None)]


@pytest.mark.parametrize("most_words, least, top, inside", [(3, 10, 2000, 50), (2, 2, 7, 50), (4, 3, 2000, 90), (3, 1, 50, 50)])
def test_against_plain_counting(spark, most_words, least, top, inside):
    given = corpus(most_words + least)
    df = spark.createDataFrame(given, SCHEMA).repartition(3)
    got = rows(co.collocations(df, most_words, least, top, inside), "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    want = brute_force(given, most_words, least, top, inside)
    assert sorted(got) == want and want


def test_padding_changes_no_count(spark):
    given = corpus(9)
    df = spark.createDataFrame(given, SCHEMA)
    frequent = co.frequent_buckets(co._texts(df, "lang", "text"), 3, 10)
    windows = co.lead_windows(co._texts(df, "lang", "text"), 3, frequent)
    everything = co.lead_windows(co._texts(df, "lang", "text"), 3, np.full_like(frequent, 255))
    few, all_of = (rows(co.phrase_counts(w, 3, 10), "lang", "phrase", "words", "f") for w in (windows, everything))
    assert few == all_of
    assert windows.where("w3 is not null").count() < everything.where("w3 is not null").count()


@pytest.mark.parametrize("limit", [1, 7, 40, 10_000])
def test_a_long_text_gives_the_same_windows_in_segments(limit):
    text = " ".join(f"w{k % 13}" + (". " if k % 5 == 0 else "") for k in range(400)).encode()

    def windows(limit):
        parts, own = zip(*co._segments(text, 2, limit), strict=True)
        words, _, begins, follow = co._windows(list(parts), list(own), 3)
        return [tuple(words.text(k + j) for j in range(follow[k] + 1)) for k in range(len(begins)) if begins[k]]

    assert windows(limit) == windows(10**9)


def test_a_task_holds_little_besides_its_windows():
    """A million windows that are counted at once, in a process that counts what it allocates."""
    words = np.random.default_rng(3).zipf(1.2, 1_100_000) % 50_000
    texts = [" ".join(f"w{w}" for w in words[k : k + 1000].tolist()) for k in range(0, len(words), 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    every = SimpleNamespace(value=np.full((1 << co.BUCKET_BITS) // 8, 255, np.uint8))
    context = SimpleNamespace(broadcast=lambda bits: every)
    given = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context), mapInArrow=lambda f, schema: f)
    count = co.lead_windows(given, 3, every.value)
    tracemalloc.start()
    try:
        found = sum(pc.sum(part.column("times")).as_py() for part in count([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == len(words)
    assert peak < 130e6


def test_repeated_rows_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(k, "en", "b a, c a, b a", "", 0) for k in range(5)], SCHEMA)
    got = rows(co.collocations(df, 2, 5), "rank", "phrase", "a", "l", "r", "n", "score")
    assert got == [(1, "b a", 10, 10, 15, 30, 666666), (2, "c a", 5, 5, 15, 30, 333333)]
    tied = spark.createDataFrame([(1, None, "a b. c d. é f. a b. c d. é f", "", 0)], SCHEMA)
    assert rows(co.collocations(tied, 2, 2), "lang", "rank", "phrase") == [("und", 1, "a b"), ("und", 2, "c d"), ("und", 3, "é f")]
    assert co.collocations(df.limit(0)).count() == 0
    assert co.collocations(df.where("doc_id = 0")).count() == 0


def test_large_numbers_are_exact(spark):
    a, left, right = 123_456_789_012_345, 223_456_789_012_345, 999_999_999_999_999
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(co._score(df.a, df.l, df.r)).first()[0] == 1_000_000 * a * a // (left * right)


def test_one_very_frequent_phrase(spark):
    texts = [(k, "en", "the of the of " * 50, "", 0) for k in range(300)] + [(k, "en", "a b c", "", 0) for k in range(30)]
    df = spark.createDataFrame(texts, SCHEMA)
    got = rows(co.collocations(df), "lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert got == brute_force(texts, 3, 10, 2000, 50)
