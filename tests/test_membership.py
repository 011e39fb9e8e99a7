"""Rows of a table of keys."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from regulink import operators as O
from regulink.operators import membership as m


def evidence(spark, n):
    return spark.range(n).selectExpr("concat(id % 7 + 1, '_', id) AS variant_id", "id % 3 AS source_id", "id AS block", "id AS words")


def test_small_and_large_tables_of_keys_give_the_same(spark, monkeypatch):
    df = evidence(spark, 5000).unionByName(spark.sql("SELECT null variant_id, 1L source_id, 1L block, 1L words"))
    df = df.unionByName(df)  # repeated rows stay
    keys = df.where("block % 5 = 2").select("variant_id").unionByName(spark.sql("SELECT null AS variant_id UNION ALL SELECT 'none'"))
    small = rows(O.with_keys(df, keys, ["variant_id"]))
    from regulink.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", -1)
    large = rows(O.with_keys(df, keys, ["variant_id"]))
    assert small == large and len(small) == 2 * 1000
    monkeypatch.setattr(m, "MOST_BLOCKS", 0)  # too many keys for a filter
    assert rows(O.with_keys(df, keys, ["variant_id"])) == small
    assert O.with_keys(df, keys.limit(0), ["variant_id"]).count() == 0
    assert O.with_keys(df.limit(0), keys, ["variant_id"]).count() == 0


def test_several_columns(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "a", 2), (None, "a", 3)], "k long, t string, v long")
    keys = spark.createDataFrame([(1, "b", 9), (2, "a", 9), (2, "a", 9), (None, "a", 9)], "k long, t string, v long")
    assert rows(O.with_keys(df, keys, ["k", "t"]), "v") == [(1,), (2,)]


def test_a_million_keys(spark, nothing_small):
    """No literal list; the scan gets the keys' range, and the filter lets few other rows through."""
    keys = spark.range(0, 2_000_000, 2).selectExpr("concat(id % 7 + 1, '_', id) AS variant_id")
    df = evidence(spark, 300_000)
    found = O.with_keys(df, keys, ["variant_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert " IN (" not in plan and len(plan) < 50_000
    assert found.count() == 150_000
    passed = m.may_be_in(df.where("block % 2 = 1"), keys, ["variant_id"], 1_000_000).count()
    assert passed < 0.02 * 150_000


def test_the_filter_holds_every_key(spark):
    keys = spark.range(3000).selectExpr("id * 977 AS k")
    assert m.may_be_in(keys, keys, ["k"], 3000).count() == 3000
    assert m.may_be_in(keys, keys, ["k"], 1).count() == 3000  # one crowded block


def test_the_range_of_keys_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    evidence(spark, 1000).write.parquet(path)
    keys = spark.createDataFrame([("3_2",), ("3_9",)], "variant_id string")
    plan = O.with_keys(spark.read.parquet(path), keys, ["variant_id"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(variant_id,3_2)" in plan and "LessThanOrEqual(variant_id,3_9)" in plan


@pytest.mark.parametrize("with_evidence", [True, False])
def test_answers_for_a_table_of_variants(spark, with_evidence):
    data = [(f"v{k % 9}", f"s{k % 2}", "f", "eqtl", f"g{k % 4}", f"id{k % 4}", k / 100, 0.1, 0.2, None) for k in range(90)]
    df = spark.createDataFrame(data, "variant_id string, source_id string, feature string, type_id string, gene_name string, gene_id string, score_scaled double, qtl_beta double, qtl_pval double, interval_score double")
    weights = {"s0": 1.0, "s1": 2.0}
    ids = spark.createDataFrame([("v1",), ("v4",), ("v4",), ("none",)], "variant_id string")
    by_table = O.variant_evidence(df, ids, None, with_evidence, weights)
    by_list = O.variant_evidence(df, ["v1", "v4", "none"], None, with_evidence, weights)
    assert rows(by_table) == rows(by_list) and by_table.count() > 0
    assert by_table.where(~F.col("variant_id").isin("v1", "v4")).count() == 0
