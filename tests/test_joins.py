"""Joins, ranks and quantiles against plain Python, with hot keys."""

import importlib
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from regulink.operators import exact_quantiles, fits_broadcast, lookup_join, number_rows, overlap_join, skew_join
from regulink.operators.joins import group_join
from regulink.session import freeze


def hot_frame(spark):
    """A third of the rows in one key, exact copies among them, and rows without a key."""
    data = [("hot", 1)] * 400 + [(f"k{i % 50}", i) for i in range(700)] + [(None, i) for i in range(100)]
    return spark.createDataFrame(data, "k string, v long").repartition(8)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    df = hot_frame(spark)
    other = spark.createDataFrame(
        [("hot", "a"), ("hot", "b"), ("k1", "c"), ("none", "d")], "k string, w string"
    )
    assert rows(skew_join(df, other, ["k"], how, hot_keys=20, salts=5)) == rows(df.join(other, "k", how))


def test_skew_join_spreads_the_hot_key(spark):
    df = hot_frame(spark)
    other = spark.createDataFrame([("hot", "a")], "k string, w string")
    joined = skew_join(df, other, ["k"], "inner", hot_keys=20, salts=16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 400
    assert len(sizes) > 3


@pytest.mark.parametrize("n, small", [(200_000, True), (300_000, False)])
def test_lookup_of_many_rows_is_not_broadcast(spark, n, small):
    """A driver holds some 200 bytes a row of a broadcast table, several times."""
    lookup = freeze(spark.range(n).selectExpr("concat('G', id) AS k", "id AS w"), "lookup", measured=True)
    joined = lookup_join(spark.range(0, 400_000, 7).selectExpr("concat('G', id) AS k", "id AS v"), lookup, ["k"], "inner")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert fits_broadcast(lookup) == small
    assert ("_salt" not in plan) == small
    assert joined.where("v = w").count() == joined.count() == len(range(0, n, 7))
    joined.collect()
    ran = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert ("SortMergeJoin" in ran) != small


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_join_computes_its_left_side_once(spark, how):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    left = spark.range(3000).selectExpr("IF(id < 2900, 0, id) AS k", "id AS v").mapInArrow(count, "k long, v long")
    right = spark.range(0, 3000, 2).selectExpr("id AS k", "id AS w")
    joined = skew_join(left, right, ["k"], how, once=True)
    got = rows(joined)
    assert seen.value == 3000
    assert got == rows(left.join(right, "k", how).select(*joined.columns))


def test_lookup_join_is_the_same_when_too_large(spark, nothing_small):
    df = hot_frame(spark)
    other = spark.createDataFrame([("hot", "a"), ("k1", "c")], "k string, w string")
    assert rows(lookup_join(df, other, ["k"], "left")) == rows(df.join(other, "k", "left"))


def test_group_join(spark):
    df = hot_frame(spark).where("k is not null")
    groups = df.groupBy("k").agg(F.max("v").alias("top"), F.count(F.lit(1)).alias("_rows"))
    joined = group_join(df, groups, ["k"], hot_groups=20)
    assert rows(joined) == rows(df.join(groups.drop("_rows"), "k").select("k", "v", "top"))


def test_number_rows(spark):
    rng = random.Random(5)
    data = [("hot", rng.randrange(10**6)) for _ in range(500)]
    data += [("hot", 7)] * 300 + [(f"g{i % 9}", i) for i in range(200)]
    df = spark.createDataFrame(data, "g string, v long").repartition(8)
    numbered = number_rows(df, ["g"], ["v"]).collect()
    for group in {g for g, _ in data}:
        values = sorted(v for g, v in data if g == group)
        mine = sorted((r["_rank"], r["v"]) for r in numbered if r["g"] == group)
        assert mine == list(enumerate(values))
        assert {r["_total"] for r in numbered if r["g"] == group} == {len(values)}


def test_exact_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {
        "hot": list(rng.normal(size=800)),
        "tied": [float(x) for x in rng.integers(0, 4, size=300)],
        "one": [2.5],
        "same": [1.0] * 40,
    }
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None), ("one", float("nan"))]
    df = spark.createDataFrame(data, "g string, v double").repartition(8)
    probs = [0.0, 0.1, 0.25, 0.68, 0.95, 1.0]
    for r in exact_quantiles(df, "v", probs, ["g"]).collect():
        assert r["n"] == len(groups[r["g"]])
        assert r["quantiles"] == pytest.approx(list(np.quantile(groups[r["g"]], probs)), abs=1e-12)


def test_exact_quantiles_without_groups(spark):
    df = spark.range(1, 102).selectExpr("cast(id as double) AS v")
    assert rows(exact_quantiles(df, "v", [0.5, 0.9])) == [([51.0, 91.0], 101)]


def intervals(rng, n):
    found = []
    for _ in range(n):
        start = rng.randrange(0, 3_000_000)
        length = rng.choice([0, 1, 5, 1023, 1024, 1025, 20_000, 300_000, 5_000_000, 90_000_000])
        found.append((rng.choice(["1", "X"]), start, start + length))
    return found + [("1", 1000, 1500)] * 60


def overlaps(a, b):
    return sorted(
        (x + y for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2]), key=repr
    )


def test_overlap_join_equals_nested_loop(spark):
    rng = random.Random(11)
    a, b = intervals(rng, 250), intervals(rng, 120)
    schema = "chrom string, start long, end long"
    joined = overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))
    assert rows(joined) == overlaps(a, b)


def test_overlap_join_is_the_same_when_too_large(spark, nothing_small):
    rng = random.Random(12)
    a, b = intervals(rng, 120), intervals(rng, 60)
    schema = "chrom string, start long, end long"
    joined = overlap_join(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))
    assert rows(joined) == overlaps(a, b)


def test_large_overlap_join_over_all_lengths(spark, nothing_small):
    """Every pair of levels, empty and reversed intervals, places before 0 and rows without a place."""
    rng = random.Random(3)

    def some(n):
        places = [(0, 0), (0, 20), (5000, 5), (1 << 40, (1 << 40) + 1), (None, 5), (7, None)]
        for _ in range(n):
            start, size = rng.choice([-500, 0, rng.randrange(10**9)]), rng.choice([0, 1, 1024, 1025, 16_384, 10**5, 10**7, 10**8, 3 * 10**9])
            places.append((start + rng.randrange(20_000), start + rng.randrange(20_000) + size))
        return [(rng.choice(["1", "1", None]), *p) for p in places]

    a, b, schema = some(250), some(200), "chrom string, start long, end long"
    x, y = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    joined = overlap_join(x, y)
    assert joined.columns == ["chrom", "start", "end", "b_chrom", "b_start", "b_end"]
    whole = [(*p, *q) for p in a for q in b if p[0] and p[0] == q[0] and None not in (*p, *q) and p[1] < q[2] and q[1] < p[2]]
    assert len(whole) > 2000 and rows(joined) == sorted(whole, key=repr)


def test_large_overlap_join_hardly_repeats_its_left_side(spark):
    module = importlib.import_module("regulink.operators.ranges")

    left = spark.range(2000).selectExpr("id * 700 AS start", "id * 700 + 200 + id % 50 * 200 AS end")
    cells = lambda rights: module._cells(F.col("start"), F.col("end"), [0, 1], rights, True)
    assert left.select(F.explode(cells([0]))).count() == 2000
    assert left.select(F.explode(cells([0, 1, 2]))).count() < 1.2 * 2000


def test_key_counts_are_bounded(spark, monkeypatch):
    """Counts are of buckets: with ten buckets, at most ten go into the list of hot ones."""
    from regulink.operators import joins

    monkeypatch.setattr(joins, "BUCKETS", 10)
    df = spark.range(5000).selectExpr("IF(id < 2000, 0, id) AS k", "id AS v")
    other = spark.range(0, 5000, 2).selectExpr("id AS k", "id AS w")
    joined = skew_join(df, other, ["k"], "inner", hot_keys=100, salts=3)
    assert "_bucket" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == rows(df.join(other, "k"))


def test_keys_of_two_types_meet_in_hot_places(spark):
    df = spark.range(300).selectExpr("CAST(id % 3 AS INT) AS k", "id AS v")
    other = spark.createDataFrame([(0, "a"), (2, "b")], "k long, w string")
    assert rows(skew_join(df, other, ["k"], "left", hot_keys=20)) == rows(df.join(other, "k", "left"))


def test_synonyms_never_broadcast_all_names(spark):
    from regulink.operators import synonym_names

    genes = spark.range(4).selectExpr("concat('N', id) AS gene_name", "id AS gene_id", "array(concat('N', id + 2)) AS gene_synonyms")
    names = synonym_names(genes)
    assert "SortMergeJoin" in names._jdf.queryExecution().executedPlan().toString()
    assert rows(names) == [("N4", 2), ("N5", 3)]


def test_overlap_join_touching_ends_do_not_overlap(spark):
    schema = "chrom string, start long, end long"
    a = spark.createDataFrame([("1", 0, 10)], schema)
    b = spark.createDataFrame([("1", 10, 20), ("1", 9, 10), ("2", 0, 10)], schema)
    assert rows(overlap_join(a, b), "b_start") == [(9,)]
