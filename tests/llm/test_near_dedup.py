"""Near-duplicate groups against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from regulink.llm import near_dedup as nd
from regulink.llm.components import components


def brute_force(texts, words, percent):
    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[k] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k), find(k) == k) for k in ids}


def corpus(seed):
    dealt = random.Random(seed)
    word = lambda: "w%d" % dealt.randrange(3000)
    texts, k = {}, 0
    passage = [word() for _ in range(25)]  # many documents share it
    for group in range(12):
        base = [word() for _ in range(dealt.choice([4, 30, 90]))]
        for _ in range(dealt.choice([2, 5, 60])):
            copy = list(base)
            for _ in range(dealt.choice([0, 1, 2, 4, 9])):
                at = dealt.randrange(len(copy) or 1)
                copy[at : at + dealt.randrange(2)] = [word()] * dealt.randrange(2)
            if group % 3 == 0:
                copy += passage
            texts[k] = dealt.choice([" ", "\n", "\t "]).join(copy)
            k += dealt.choice([1, 3])
    return texts | {k: "One", k + 1: "oNE", k + 2: "", k + 3: None, k + 4: " \n", k + 5: "É", k + 6: "é", k + 7: "a b"}


@pytest.mark.parametrize("seed, small, words, percent", [(1, 32, 3, 85), (2, 2, 3, 85), (3, 4, 5, 80)])
def test_groups(spark, monkeypatch, seed, small, words, percent):
    monkeypatch.setattr(nd, "SMALL_BUCKET", small)
    monkeypatch.setattr(nd, "BLOCK", 7)
    texts = corpus(seed)
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, bands string")
    got = {r["doc_id"]: tuple(r)[1:] for r in nd.near_duplicates(df, words, percent).collect()}
    assert got == brute_force(texts, words, percent)


def test_rows_without_id_repeated_rows_and_empty_table(spark):
    given = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, "a b c d e f")]
    df = spark.createDataFrame(given, "doc_id long, text string")
    got = sorted(map(tuple, nd.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True)] * 2 + [(2, 2, 1, False), (None, 2, None, True), (None, 0, None, True)], key=repr)
    kept = sorted((r["doc_id"] for r in nd.keep_one(df).collect()), key=repr)
    assert kept == [1, None, None]
    assert nd.near_duplicates(df.limit(0)).count() == 0


A, B, C = "a b c d e f g", "h i j k l m n", "o p q r s t u"


def test_a_repeated_id_loses_no_text(spark):
    given = [(3, B, 1), (7, A, 2), (7, B, 3), (7, B, 4), (9, None, 5), (9, "", 6), (8, C, 7), (8, A + " x", 8), (None, B, 9)]
    df = spark.createDataFrame(given, "doc_id long, text string, _place int")
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    texts = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert texts == sorted([(3, B), (7, A), (9, None), (9, ""), (8, C), (8, A + " x"), (None, B)], key=repr)


def test_texts_of_one_id_are_one_document(spark):
    df = spark.createDataFrame([(3, B), (7, A), (7, B), (11, A), (12, C)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in nd.near_duplicates(df).collect())
    assert got == [(3, 3, True), (7, 3, False), (7, 3, False), (11, 3, False), (12, 12, True)]


def test_bands_rarely_miss():
    for percent in (80, 85):
        assert (1 - (percent / 100) ** nd.BAND_ROWS) ** nd.bands_for(percent) <= nd.MISS


def test_min_and_max_estimate_similarity():
    dealt = np.random.default_rng(4)
    shared, own = dealt.integers(0, 1 << 63, 600, np.uint64), dealt.integers(0, 1 << 63, 400, np.uint64)
    sets = [np.concatenate([shared, own[:200]]), np.concatenate([shared, own[200:]])]
    values = nd.min_max(np.concatenate(sets), np.array([0, 800]), 2000)
    assert abs((values[:, 0] == values[:, 1]).mean() - 0.6) < 0.03


def test_long_chain_is_one_component(spark):
    links = spark.range(200).selectExpr("id + 1 a", "id b")
    assert {r["component"] for r in components(links).collect()} == {0}
