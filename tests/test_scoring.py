"""Scores, scaling and look-up."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from regulink import operators as O
from regulink.fixed_values import CONSEQUENCE_WEIGHTS_V1, FEATURE_WEIGHTS, SOURCE_WEIGHTS
from regulink.plans import prepare_evidence, score_v1, score_v2, write_scores

EVIDENCE = (
    "variant_id string, gene_name string, gene_id string, type_id string, source_id string, "
    "feature string, qtl_beta double, qtl_pval double, interval_score double"
)


def evidence(spark, data):
    return spark.createDataFrame(data, EVIDENCE)


def item(variant, gene, kind, source, feature, pval=None, score=None, beta=None):
    return (variant, gene, f"id_{gene}", kind, source, feature, beta, pval, score)


def grid_position(x, values, n):
    """Position on the quantile grid, written independently: mean of forward and backward lookup."""
    ordered, last = sorted(values), len(values) - 1
    q = np.array(
        [
            ordered[i * last // (n - 1)]
            + (ordered[min(i * last // (n - 1) + 1, last)] - ordered[i * last // (n - 1)])
            * (i * last % (n - 1) / (n - 1))
            for i in range(n)
        ]
    )
    r = np.linspace(0, 1, n)
    if x == q[0]:
        return 0.0
    if x == q[-1]:
        return 1.0
    return 0.5 * (np.interp(x, q, r) - np.interp(-x, -q[::-1], -r[::-1]))


@pytest.mark.parametrize("n", [10, 100])
def test_quantile_scale(spark, n):
    rng = np.random.default_rng(8)
    groups = {
        "hot": list(rng.random(700)),
        "tied": [float(v) for v in rng.integers(0, 5, size=200)],
        "tiny": [1.0, 4.0, 9.0],
        "same": [3.0] * 20,
    }
    data = [("s", f, float(v)) for f, vs in groups.items() for v in vs]
    df = spark.createDataFrame(
        data + [("s", "hot", None), ("s", "hot", float("nan")), (None, "hot", 1.0)],
        "source_id string, feature string, score double",
    ).repartition(8)
    scaled = O.quantile_scale(df, n).collect()
    assert len(scaled) == len(data)
    for r in scaled:
        assert 0 <= r["score_scaled"] <= 1
        assert r["score_scaled"] == pytest.approx(
            grid_position(r["score"], groups[r["feature"]], n), abs=1e-9
        )
    hot = sorted((r["score"], r["score_scaled"]) for r in scaled if r["feature"] == "hot")
    assert [s for _, s in hot] == sorted(s for _, s in hot)
    assert {r["score_scaled"] for r in scaled if r["feature"] == "same"} == {0.0}


def test_quantile_scale_is_the_same_when_too_large(spark, nothing_small):
    data = [("s", "f", float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(data, "source_id string, feature string, score double")
    values = [v for _, _, v in data]
    for r in O.quantile_scale(df, 10).collect():
        assert r["score_scaled"] == pytest.approx(grid_position(r["score"], values, 10), abs=1e-9)


@pytest.mark.parametrize("n", [2, 10, 100])
def test_kept_grids_score_slices_as_the_whole(spark, n):
    rng = random.Random(n)
    data = [("s", f"f{k % 4}", rng.choice([float(rng.randrange(9)), rng.random(), None, float("nan")]), k) for k in range(1500)]
    df = spark.createDataFrame([*data, (None, "f1", 1.0, -1), ("s", "same", 3.0, -2)], "source_id string, feature string, score double, k long")
    whole = rows(O.quantile_scale(df, n), "k", "score_scaled")
    grids = O.fit_quantile_grids(df, n)
    parts = [O.apply_quantile_grids(df.where(F.col("k") % 3 == j), grids) for j in range(-2, 3)]
    assert sorted({r for p in parts for r in rows(p, "k", "score_scaled")}, key=repr) == whole


def test_values_outside_kept_grids(spark):
    schema = "source_id string, feature string, score double"
    grids = O.fit_quantile_grids(spark.createDataFrame([("s", "f", float(v)) for v in range(11)] + [("s", "one", 5.0)], schema), 11)
    new = spark.createDataFrame([("s", "f", v) for v in (-3.0, 0.0, 2.5, 10.0, 99.0)] + [("s", "one", v) for v in (1.0, 5.0, 9.0)], schema)
    got = rows(O.apply_quantile_grids(new, grids), "feature", "score", "score_scaled")
    assert got == sorted([("f", -3.0, 0.0), ("f", 0.0, 0.0), ("f", 2.5, 0.25), ("f", 10.0, 1.0), ("f", 99.0, 1.0), ("one", 1.0, 0.0), ("one", 5.0, 0.0), ("one", 9.0, 1.0)], key=repr)
    other = spark.createDataFrame([("s", "new", 1.0), ("s", "f", None)], schema)
    assert O.apply_quantile_grids(other, grids, on_unknown="drop").count() == 0
    with pytest.raises(Exception, match="no quantile grid for: s/new"):
        O.apply_quantile_grids(other, grids).collect()


def test_applying_grids_reads_the_slice_once(spark):
    df = spark.range(100).selectExpr("'s' AS source_id", "'f' AS feature", "cast(id as double) AS score")
    grids = O.fit_quantile_grids(df, 10)
    plan = O.apply_quantile_grids(df, grids)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_quantile_bins_with_fewer_rows_than_bins(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(3)], "g string, score double")
    assert rows(O.quantile_bins(df, 10, ["g"]), "score", "bin") == [(0.0, 1), (1.0, 2), (2.0, 3)]


def test_quantile_bins_splits_copies_evenly(spark):
    df = spark.createDataFrame([("a", 1.0)] * 100, "g string, score double").repartition(8)
    counts = O.quantile_bins(df, 10, ["g"]).groupBy("bin").count()
    assert rows(counts) == sorted([(b, 10) for b in range(1, 11)], key=repr)


def bins_of(values, bins):
    """Bin of each place of a sorted list."""
    share, longer = divmod(len(values), bins)
    sizes = [share + (b < longer) for b in range(bins)]
    return [b + 1 for b, size in enumerate(sizes) for _ in range(size)]


@pytest.mark.parametrize("bins", [1, 2, 7, 10, 40])
def test_quantile_bins_equal_sorting(spark, bins):
    """Nulls, NaN, ties in the order, exact copies on and off borders, groups of all sizes."""
    rng = random.Random(bins)
    nan = float("nan")
    data = [("hot", rng.choice([None, nan, 0.0, 1.5, 2.0]), rng.choice([None, "a", "b"]), k % 3) for k in range(900)]
    data += [("copies", 1.0, "same", 0)] * 333 + [("two", 1.0, "a", 0)] * 5 + [("two", 1.0, "a", 1)] * 4
    data += [("one", None, None, 5), (None, 1.0, "left out", 5)] + [("small", float(k), "x", k) for k in range(6)]
    df = spark.createDataFrame(data, "g string, v double, w string, _bin int").repartition(6)
    got = O.quantile_bins(df, bins, ["g"], ["v", "w"]).collect()
    assert sorted(map(repr, (tuple(r)[:4] for r in got))) == sorted(repr(r) for r in data if r[0] is not None)

    def place(r):
        v, w = r["v"], r["w"]
        return ((0, 0) if v is None else (2, 0) if math.isnan(v) else (1, v), (0, "") if w is None else (1, w))

    for g in ("hot", "copies", "two", "one", "small"):
        ordered = sorted((place(r), r["bin"]) for r in got if r["g"] == g)
        assert [b for _, b in ordered] == bins_of(ordered, bins)


def test_quantile_bins_write_keys_only(spark, monkeypatch):
    """No table on the way holds all columns, and the plan neither sorts nor exchanges the rows."""
    from regulink.operators import ranking

    written = []
    freeze = ranking.freeze
    monkeypatch.setattr(ranking, "freeze", lambda df, *a, **k: written.append(df.columns) or freeze(df, *a, **k))
    df = spark.range(2000).selectExpr("'g' || id % 3 AS g", "id % 50 AS v", "id AS a", "'text' AS wide")
    binned = O.quantile_bins(df, 10, ["g"], ["v"])
    assert written and not any({"a", "wide"} & set(columns) for columns in written)
    plan = binned._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "hashpartitioning" not in plan
    assert rows(binned.groupBy("g", "bin").count().select("count").distinct()) in ([(66,), (67,)], [(67,), (66,)])


def test_evidence_score_by_type(spark):
    weights = O.weights_frame(spark, {"missense_variant": 0.7, "unscored": None})
    df = evidence(
        spark,
        [
            item("v", "a", "pchic", "javierre2016", "T", score=5.0),
            item("v", "b", "fantom5", "andersson2014", "T", score=0.0),
            item("v", "c", "dhscor", "thurman2012", "T", score=float("nan")),
            item("v", "d", "vep", "vep", "missense_variant"),
            item("v", "e", "vep", "vep", "unscored"),
            item("v", "f", "eqtl", "gtex_v7", "T", pval=0.25),
        ],
    )
    scored = O.evidence_score(df, weights)
    assert rows(scored, "gene_name", "score") == sorted(
        [("a", 5.0), ("b", None), ("c", None), ("d", 0.7), ("e", None), ("f", 0.75)], key=repr
    )


def test_unknown_type_is_an_error_unless_allowed(spark):
    weights = O.weights_frame(spark, {"x": 1.0})
    df = evidence(spark, [item("v", "a", "pqtl", "sun2018", "T", pval=0.1)])
    with pytest.raises(Exception, match="unknown evidence type: pqtl"):
        O.evidence_score(df, weights).collect()
    assert rows(O.evidence_score(df, weights, on_unknown="null"), "score") == [(None,)]
    assert rows(O.evidence_score(df, weights, ["eqtl", "pqtl"]), "score") == [(0.9,)]


def test_unknown_term_is_an_error(spark):
    df = evidence(spark, [item("v", "a", "vep", "vep", "nonsense")])
    with pytest.raises(Exception, match="no weight for term: nonsense"):
        O.evidence_score(df, O.weights_frame(spark, CONSEQUENCE_WEIGHTS_V1)).collect()


def test_unknown_source_is_an_error(spark):
    df = spark.createDataFrame([("v", "other", "g", 0.5)], "variant_id string, source_id string, gene_name string, score double")
    with pytest.raises(Exception, match="no weight for source: other"):
        O.variant_gene_scores(df).collect()


def test_equal_weights_give_the_mean(spark):
    data = [("v", s, "g", x) for s, x in [("vep", 0.1), ("gtex_v7", 0.4), ("sun2018", 1.0)]]
    df = spark.createDataFrame(data, "variant_id string, source_id string, gene_name string, score double")
    assert O.variant_gene_scores(df).first()["src_agg"] == pytest.approx(0.5)


@pytest.mark.parametrize("bounded", [False, True])
def test_minmax(spark, bounded):
    data = [("v", "s", 1), ("v", "s", 3), ("v", "s", 5), ("v", "t", 2), ("v", "t", 2)]
    df = spark.createDataFrame(data, "variant_id string, source_id string, ft_count long")
    scaled = O.minmax(df, one_row_per_gene=bounded)
    assert rows(scaled, "source_id", "ft_count", "ft_count_scaled") == [
        ("s", 1, 0.0), ("s", 3, 0.5), ("s", 5, 1.0), ("t", 2, 0.0), ("t", 2, 0.0),
    ]


def sample():
    rng = np.random.default_rng(2)
    kinds = [("pchic", "javierre2016"), ("dhscor", "thurman2012"), ("eqtl", "gtex_v7"), ("vep", "vep")]
    data = []
    for i in range(400):
        kind, source = kinds[i % 4]
        feature = ["missense_variant", "stop_gained", "intron_variant"][i % 3] if kind == "vep" else f"T{i % 3}"
        data.append(
            item(
                f"v{rng.integers(0, 6)}", f"g{rng.integers(0, 4)}", kind, source, feature,
                pval=float(rng.random()) if kind == "eqtl" else None,
                score=float(rng.integers(0, 9)) if kind in ("pchic", "dhscor") else None,
                beta=0.1,
            )
        )
    return data


def weighted(pairs):
    values, weights = zip(*pairs)
    return np.average(values, weights=weights)


def plain_scores(data, n):
    """Both versions of the score in plain Python."""
    scored = []
    for v, g, _, kind, source, feature, _, pval, score in data:
        if kind == "vep":
            x, feature = CONSEQUENCE_WEIGHTS_V1[feature], "not_a_feature"
        else:
            x = 1 - pval if kind == "eqtl" else score
        if kind == "vep" or x != 0:
            scored.append((v, g, source, feature, x))
    grouped = {}
    for _, _, source, feature, x in scored:
        grouped.setdefault((source, feature), []).append(x)
    placed = {}
    for v, g, source, feature, x in scored:
        placed.setdefault((v, source, g), []).append(grid_position(x, grouped[source, feature], n))
    return placed


def test_score_v2_equals_plain_python(spark):
    data = sample()
    weights = O.weights_frame(spark, CONSEQUENCE_WEIGHTS_V1)
    result = score_v2(evidence(spark, data), weights)["per_variant_scores"]
    expected = {}
    for (v, source, g), xs in plain_scores(data, 10).items():
        expected.setdefault((v, g), []).append((max(xs), SOURCE_WEIGHTS[source]))
    got = {(r["variant_id"], r["gene_name"]): r["src_agg"] for r in result.collect()}
    assert got == pytest.approx({k: weighted(v) for k, v in expected.items()}, abs=1e-9)


def test_score_v1_equals_plain_python(spark, tmp_path):
    data = sample()
    weights = O.weights_frame(spark, CONSEQUENCE_WEIGHTS_V1)
    tables = score_v1(evidence(spark, data), weights)
    placed = plain_scores(data, 100)
    expected = {}
    for (v, source, g), xs in placed.items():
        counts = [len(ys) for (v2, s2, _), ys in placed.items() if (v2, s2) == (v, source)]
        low, high = min(counts), max(counts)
        share = (len(xs) - low) / (high - low) if high > low else 0.0
        w = FEATURE_WEIGHTS[source]
        mean = np.average([max(xs), share], weights=[w["ft_max"], w["ft_count_scaled"]])
        expected.setdefault((v, g), []).append((mean, SOURCE_WEIGHTS[source]))
    result = tables["per_variant_aggregate_scores"]
    got = {(r["variant_id"], r["gene_name"]): r["src_agg"] for r in result.collect()}
    assert got == pytest.approx({k: weighted(v) for k, v in expected.items()}, abs=1e-9)
    write_scores(tables, str(tmp_path / "scores"))
    written = spark.read.csv(str(tmp_path / "scores/per_variant_aggregate_scores"), sep="\t", header=True)
    assert written.count() == len(got)


def test_rank_genes_shares_ranks(spark):
    df = spark.createDataFrame(
        [("v", "a", 0.5), ("v", "b", 0.9), ("v", "c", 0.5), ("v", "d", 0.1)],
        "variant_id string, gene_name string, src_agg double",
    )
    ranks = {r["gene_name"]: r["rank"] for r in O.rank_genes(df).collect()}
    assert ranks == {"b": 1, "a": 2, "c": 2, "d": 4}


def test_nested_answer(spark):
    weights = O.weights_frame(spark, CONSEQUENCE_WEIGHTS_V1)
    prepared = prepare_evidence(evidence(spark, sample()), weights, 10)
    wanted = ["vep", "gtex_v7"]
    answer = O.nested_answers(prepared, ["v1"], wanted).collect()
    assert len(answer) == 1
    assert [s["source_id"] for s in answer[0]["va_evidence"]] == ["gtex_v7", "vep"]
    assert [r["rank"] for r in answer[0]["va_rank"]] == sorted(r["rank"] for r in answer[0]["va_rank"])
    assert all(r["gene_id"] is not None for r in answer[0]["va_rank"])
    entries = [e for s in answer[0]["va_evidence"] for t in s["sa_evidence"] for e in t["raw_evidence"]]
    assert len(entries) == prepared.where("variant_id = 'v1'").where(F.col("source_id").isin(wanted)).count()
    for source in answer[0]["va_evidence"]:
        assert {r["gene_name"] for r in source["sa_rank"]} == {
            e["gene_name"] for t in source["sa_evidence"] for e in t["raw_evidence"]
        }
        assert all(
            (e["beta"] is not None) == (source["source_id"] == "gtex_v7") and e["interval_score"] is None
            for t in source["sa_evidence"]
            for e in t["raw_evidence"]
        )
    ranks = O.variant_evidence(prepared, ["v1"], wanted, with_evidence=False)
    assert sorted(ranks.columns) == ["gene_id", "gene_name", "rank", "score", "variant_id"]
    assert {(r["rank"], r["gene_name"]) for r in ranks.collect()} == {
        (r["rank"], r["gene_name"]) for r in answer[0]["va_rank"]
    }


def test_scaling_meets_one_row_for_each(spark):
    df = spark.range(1000).selectExpr("'s' AS source_id", "'f' AS feature", "sqrt(id % 97) AS score")
    scaled = O.quantile_scale(df, 100)
    assert scaled.count() == 1000
    plan = scaled._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any("<" in line for line in joins)


def test_repeated_terms(spark):
    df = evidence(spark, [item("v", "g", "vep", "vep", "t")])
    same = spark.createDataFrame([("t", 0.5), ("t", 0.5)], "term string, weight double")
    assert O.evidence_score(df, same).first()["score"] == 0.5
    other = spark.createDataFrame([("t", 0.5), ("t", 0.7)], "term string, weight double")
    with pytest.raises(Exception, match="several weights for term: t"):
        O.evidence_score(df, other).collect()


def test_large_groups_keep_one_shape(spark):
    data = [item("hot", f"g{i % 5}", "eqtl", "gtex_v7", "T", pval=0.1) for i in range(300)]
    data += [item("v", "g", "eqtl", "gtex_v7", "T", pval=0.2)]
    df = evidence(spark, data).repartition(8).withColumn("score_scaled", F.lit(0.5))
    assert O.tissue_evidence(df).count() == 301
    for answer in (O.variant_evidence(df), O.source_evidence(df)):
        assert answer.groupBy("variant_id", "rank").count().collect() != []
        assert rows(answer.groupBy("variant_id", "rank").count()) == [("hot", 1, 300), ("v", 1, 1)]


def test_evidence_matrix(spark):
    data = [("v", "a", "x", 0.2), ("v", "a", "x", 0.4), ("v", "b", "y", 1.0), ("w", "c", "x", 0.9)]
    df = spark.createDataFrame(data, "variant_id string, gene_name string, source_id string, score_scaled double")
    matrix = O.evidence_matrix(df, "v", "source_id", ["x", "y"])
    assert matrix.columns == ["gene_name", "x", "y"]
    assert rows(matrix) == [("a", pytest.approx(0.3), None), ("b", None, 1.0)]
