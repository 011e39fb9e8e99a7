"""Stored summaries of slices, and the errors they state."""

import math
import random
import statistics

import pytest
from conftest import rows

from regulink import operators as O
from regulink.operators.sketches import quantile_k

PROBS = (0.1, 0.5, 0.9, 0.99)


def values(seed, n):
    dealt = random.Random(seed)
    return [dealt.choice([dealt.gauss(0, 1), dealt.expovariate(0.1), 7.0]) for _ in range(n)]


def rank_gap(data, found, p):
    """How far the ranks of ``found`` are from ``p``."""
    below, up_to = sum(v < found for v in data) / len(data), sum(v <= found for v in data) / len(data)
    return max(0, below - p, p - up_to)


@pytest.mark.parametrize("error", [0.05, 0.01, 0.002])
def test_quantiles_keep_their_error(spark, error):
    data = values(1, 40_000)
    df = spark.createDataFrame([(v,) for v in data], "delta double").repartition(7)
    got = O.describe_distance(df, probs=PROBS, error=error).first()
    for p in (0.1, 0.25, 0.5, 0.75, 0.9, 0.99):
        assert rank_gap(data, got[f"p{round(p * 100)}"], p) <= 2 * error  # stated with 99 percent
    assert got["count"] == len(data) and got["min"] == min(data) and got["max"] == max(data)
    assert math.isclose(got["mean"], statistics.fmean(data)) and math.isclose(got["std"], statistics.stdev(data))


def test_one_pass(spark):
    df = spark.range(100).selectExpr("cast(id as double) AS delta")
    plan = O.describe_distance(df, error=0.01)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_sketch_size_follows_the_error():
    for error in (0.05, 0.01, 0.001):
        assert O.rank_error(quantile_k(error)) <= error < O.rank_error(quantile_k(error) - 1)
    for error in (0, 1, 1e-9):
        with pytest.raises(ValueError):
            quantile_k(error)


def test_merging_equals_summarising_at_once(spark, tmp_path):
    data = [(f"s{k % 5}", "big" if k % 9 else "small", None if k % 11 == 0 else v + 1e6, k % 3000, k % 7) for k, v in enumerate(values(2, 30_000))]
    data += [("s9", "empty", None, None, 1), ("s9", "one", 4.0, 1, 1), ("s9", "nan", float("nan"), 1, 1)]
    df = spark.createDataFrame(data, "slice string, kind string, x double, a long, b long").repartition(4)
    for name in sorted({r[0] for r in data}):  # slices arrive one by one
        part = O.summarise_slices(df.where(df.slice == name), ["slice", "kind"], "x", ["a", "b"])
        part.write.parquet(str(tmp_path / "slices"), mode="append")
    kept = spark.read.parquet(str(tmp_path / "slices"))
    merged = O.describe_slices(O.merge_slices(kept, ["kind"]), PROBS).collect()
    for r in merged:
        mine = [d for d in data if d[1] == r["kind"]]
        x = [d[2] for d in mine if d[2] is not None and not math.isnan(d[2])]
        assert (r["rows"], r["count"]) == (len(mine), len(x))
        if not x:
            assert r["mean"] is r["std"] is r["p50"] is r["min"] is None
            continue
        assert math.isclose(r["mean"], statistics.fmean(x), rel_tol=1e-12)
        assert r["std"] is None if len(x) == 1 else math.isclose(r["std"], statistics.stdev(x), rel_tol=1e-9)
        for p in PROBS:
            assert rank_gap(x, r[f"p{round(p * 100)}"], p) <= 2 * O.rank_error()
        for place, name in ((3, "a"), (4, "b")):
            exact = len({d[place] for d in mine if d[place] is not None})
            assert abs(r[name] - exact) <= 4 * O.distinct_error() * exact + 0.5
    whole = O.describe_slices(O.merge_slices(kept), PROBS).first()
    assert whole["rows"] == len(data)


def test_stored_slices_merge_in_any_order(spark):
    df = spark.range(20_000).selectExpr("id % 13 AS slice", "cast(id % 977 as double) AS x", "id % 5000 AS a")
    slices = O.summarise_slices(df, ["slice"], "x", ["a"])
    once = O.describe_slices(O.merge_slices(slices), (0.5,)).first()
    halves = [O.merge_slices(slices.where(f"slice % 2 = {k}")) for k in (0, 1)]
    twice = O.describe_slices(O.merge_slices(halves[0].unionByName(halves[1])), (0.5,)).first()
    assert once["a"] == twice["a"] and once["rows"] == twice["rows"] == 20_000
    assert math.isclose(once["mean"], twice["mean"]) and math.isclose(once["std"], twice["std"])


def test_distinct_variants_by_a_sketch(spark):
    df = spark.range(50_000).selectExpr("id AS position", "concat('v', id % 20000) AS variant_id")
    for lg_k in (10, 14):
        got = O.slice_stats(df, lg_k).first()
        assert abs(got["variants"] - 20_000) <= 4 * O.distinct_error(lg_k) * 20_000
        assert (got["rows"], got["size_bp"]) == (50_000, 49_999)
    assert rows(O.slice_stats(df.limit(0), 12)) == [(0, None, 0)]
