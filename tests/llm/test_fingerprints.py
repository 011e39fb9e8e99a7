"""Fingerprints: edited texts by hand, likeness against generalised Jaccard similarity."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regulink.llm import fingerprints as fp


def similarity(a, b):
    a, b = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in (a, b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def corpus():
    dealt = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    texts = {7 * k: " ".join(dealt.choices(words, range(60, 0, -1), k=dealt.choice([1, 5, 40, 90]))) for k in range(250)}
    return texts | {3: "", 10: None, 17: " \n", 1001: "é" * 5, 1008: "x" * 3000, 1015: texts[7], 2000: "last one first"}


@pytest.mark.parametrize("rows_in_bucket", [500, 9])
def test_against_plain_computation(spark, monkeypatch, rows_in_bucket):
    monkeypatch.setattr(fp, "BUCKET_ROWS", rows_in_bucket)
    texts = corpus()
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in texts.items()], "doc_id long, text string, place string, bucket int")
    printed = fp.fingerprints(df).persist()
    got = {r["doc_id"]: r for r in fp.compare_fingerprints(printed).collect()}
    order = sorted(texts, reverse=True)
    assert len(got) == len(order)
    off_edited, off_next, same = [], [], {}
    for k, doc_id in enumerate(order):
        text, after = texts[doc_id] or "", texts[order[(k + 1) % len(order)]] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        r = got[doc_id]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert same.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if edited == text:
            assert r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"]
        if text.strip() and after.strip():
            off_edited.append(r["near_edited"] - similarity(text, edited))
            off_next.append(r["near_next"] - similarity(text, after))
    for off in (off_edited, off_next):
        assert abs(sum(off) / len(off)) < 0.02
        assert (sum(x * x for x in off) / len(off)) ** 0.5 < 1.2 * (0.25 / fp.SAMPLES) ** 0.5
    printed.unpersist()


def test_ids_that_repeat_or_are_missing(spark):
    df = spark.createDataFrame([(1, "b b b"), (1, "a a a"), (None, "c c c"), (1, "b b b")], "doc_id long, text string")
    rows = sorted(tuple(r) for r in fp.fingerprints(df).select(F.coalesce("doc_id", F.lit(-1)), "edited_sha256").collect())
    wanted = [(1, "a a " + "b"), (1, "b b " + "b"), (1, "b b " + "c"), (-1, "c c " + "a")]
    assert rows == sorted((k, hashlib.sha256(t.encode()).hexdigest()) for k, t in wanted)


def test_empty_table_and_native_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    printed = fp.fingerprints(df)
    assert fp.compare_fingerprints(printed).count() == 0
    plan = printed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_only_numbers_of_buckets_are_put_in_order(spark):
    df = spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id long, text string")
    tops = df.groupBy((F.col("doc_id") % 50).cast("int").alias("_b")).agg(F.max("doc_id").alias("_top"))
    heads = df.where("doc_id < 50").select(F.col("doc_id").cast("int").alias("bucket"), F.col("text").alias("head"))
    after = fp._following(tops, heads)
    assert {(r["bucket"], r["_after"]) for r in after.collect()} == {(k, f"text {(k + 1) % 50}") for k in range(50)}
    plan = after._jdf.queryExecution().optimizedPlan().toString()
    assert all("head" not in line for line in plan.splitlines() if "Window" in line)
