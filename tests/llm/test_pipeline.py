"""The pipeline's stages one after another, against what each is to do, and the SQL of the URL query."""

from pathlib import Path

import corpus_pipeline as cp
import duckdb
import pytest
from test_near_dedup import brute_force
from test_packing import check

import __spark_entry__ as entry_module
from regulink.llm import queries

FOLDER = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 !", None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, str(FOLDER)).persist()
        assert docs.columns == columns
        seen[name] = before, {r["doc_id"]: r["text"] for r in docs.collect()}
    before, after = seen["language"]
    assert set(before) - set(after) == {10**6, 10**6 + 1}
    before, after = seen["near_dedup"]
    wanted = brute_force(before, 5, 80)
    assert set(after) == {k for k, (_, _, kept) in wanted.items() if kept}
    before, after = seen["decontaminate"]
    assert {k for k, t in before.items() if any(i in t for i in items)} <= set(before) - set(after)
    assert len(after) > 0.8 * len(before)
    before, after = seen["personal_data"]
    assert set(before) == set(after) and all("@mail" not in t for t in after.values())
    rows = cp.STAGES[-1][1](spark, docs, str(FOLDER)).collect()
    sequences, total = check(rows, after, 2048)
    assert sequences <= 1.02 * total / 2048 + 1


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    engine = duckdb.connect()
    for name_of in ("pages", "documents"):
        engine.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{FOLDER}/{name_of}.parquet'")
    result = queries.QUERIES[name](spark, str(FOLDER))
    relation = engine.sql(queries.ORACLES[name])
    order = [relation.columns.index(c) for c in result.columns]
    wanted = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    assert sorted(map(tuple, result.collect()), key=repr) == wanted
