"""Views that Spark builds in another way than their text says."""

from conftest import rows

from workload.views import VIEWS, Data

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_returnflag string"


def test_links_are_told_apart_by_narrow_keys(spark, tmp_path):
    lines = [(1, 7, 3, 5.0, 0.1, "A"), (1, 7, 8, 5.0, 0.1, "A"), (402, 7, 3, 5.9, 0.1, "A"), (1, 7, 3, 5.0, 0.2, "A")]
    for i in range(6):
        lines += [tuple(None if i == k else v for k, v in enumerate(line)) for line in lines[:4]]
    lines += [(None, 7, 3, 6.0, 0.1, "A"), (1, 8, 3, 5.0, float("nan"), "N"), (1, 8, 3, 5.0, float("nan"), "N")]
    lines += [(1, 9, 3, 5.0, 0.0, "N"), (1, 9, 3, 5.0, -0.0, "N")]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    data = Data(spark, str(tmp_path))
    by_text = spark.sql(VIEWS["v_links"], lineitem=data.table("lineitem"))
    found = data.sql("SELECT * FROM v_links")
    assert found.dtypes == by_text.dtypes
    assert repr(rows(found)) == repr(rows(by_text))  # as text, since NaN is unlike itself
    first = str(found._jdf.queryExecution().optimizedPlan()).rsplit("Aggregate [", 1)[1].split("]", 1)[0]
    assert "concat" not in first and len(first.split(", ")) == 6
