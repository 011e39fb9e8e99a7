"""Aggregates, scaling, scores, ranks and evidence look-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink import operators as O
from regulink.fixed_values import CONSEQUENCE_WEIGHTS_V1
from regulink.plans import fit_evidence_grids, prepare_evidence, prepare_slice, score_v1, score_v2
from regulink.session import freeze, scratch_path
from regulink.sources import read_grids, write_grids
from workload.columns import SCORE_SQL, SIGNIFICANT
from workload.joins import DELTAS
from workload.registry import query
from workload.views import Data


@query(
    "a1_keep_best",
    """SELECT chrom, start_pos AS start, end_pos AS "end", gene_id, max(score) AS score FROM v_repeated
GROUP BY ALL""",
)
def keep_best(d: Data) -> DataFrame:
    return O.keep_best(d.view("v_repeated"))


@query("a2_distinct", 'SELECT DISTINCT chrom, start_pos AS start, end_pos AS "end" FROM v_repeated')
def distinct_rows(d: Data) -> DataFrame:
    return d.view("v_repeated").select("chrom", "start", "end").distinct()


@query("a3_feature_list", f"SELECT DISTINCT type_id AS type, study_id, bio_feature FROM v_qtl WHERE {SIGNIFICANT}")
def feature_list(d: Data) -> DataFrame:
    kept = O.standardise_qtl(O.bonferroni(d.view("v_qtl")))
    return O.feature_list(kept, ["type", "study_id", "bio_feature"])


@query("a9_first_per_key", "SELECT chrom, pos, gene_id, pval FROM v_qtl QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY pval, chrom, pos) = 1")
def first_per_key(d: Data) -> DataFrame:
    qtl = d.view("v_qtl").select("chrom", "pos", "gene_id", "pval")
    return O.first_per_key(qtl, ["gene_id"], ["pval", "chrom", "pos"])


@query(
    "a10_slice_stats",
    "SELECT count(*) AS rows, max(position) - min(position) AS size_bp, count(DISTINCT variant_id) AS variants FROM v_evidence",
)
def slice_stats(d: Data) -> DataFrame:
    return O.slice_stats(d.view("v_evidence"))


@query("a12_null_report", "SELECT count(*) AS rows, count(*) FILTER (gene_id IS NULL) AS gene_id, count(*) FILTER (pval IS NULL) AS pval FROM v_qtl")
def null_report(d: Data) -> DataFrame:
    return O.null_report(d.view("v_qtl"), "gene_id", "pval")


@query("a12_assert_no_nulls", "SELECT chrom, pos, pval FROM v_qtl")
def assert_no_nulls(d: Data) -> DataFrame:
    return O.assert_no_nulls(d.view("v_qtl").select("chrom", "pos", "pval"), "pval")


DESCRIBE_SQL = f"""{DELTAS} SELECT count(delta) AS count, round(avg(delta), 4) AS mean,
 round(stddev_samp(delta), 4) AS std, min(delta) AS min,
 {", ".join(f"round(quantile_cont(delta, {p}), 4) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.68, 0.75, 0.9, 0.95))},
 max(delta) AS max FROM deltas"""
HISTOGRAM_SQL = f"""{DELTAS}, span AS (SELECT min(delta) AS a, max(delta) AS b FROM deltas),
counts AS (
  SELECT least(CAST(floor(1000 * (delta - a) / (b - a)) AS INTEGER), 999) AS bin, count(*) AS n
  FROM deltas, span GROUP BY 1)
SELECT g.bin, round(a + g.bin * (b - a) / 1000.0, 4) AS low, round(a + (g.bin + 1) * (b - a) / 1000.0, 4) AS high,
       coalesce(n, 0) AS count
FROM (SELECT unnest(range(0, 1000)) AS bin) g CROSS JOIN span LEFT JOIN counts ON counts.bin = g.bin"""


def rounded_summary(summary: DataFrame) -> DataFrame:
    return summary.withColumns({c: F.round(c, 4) for c in summary.columns if c not in ("count", "min", "max")})


def rounded_bins(bins: DataFrame) -> DataFrame:
    return bins.withColumns({"low": F.round("low", 4), "high": F.round("high", 4)})


@query("a14_describe_distance", DESCRIBE_SQL)
def describe_distance(d: Data) -> DataFrame:
    return rounded_summary(O.describe_distance(O.link_distances(d.view("v_intervals"), d.genes())))


SOURCES = ["andersson2014", "gtex_v7", "javierre2016", "thurman2012", "vep"]
POINTS = (0.25, 0.5, 0.68, 0.75, 0.9, 0.95)


def _near_ranks(df: DataFrame, col: str, summary: DataFrame, error: float) -> list:
    """For each quantile of a summary, whether its true rank is at most ``error`` away from the one
    asked for."""
    found = []
    for p in POINTS:
        point = summary.select(f"p{round(p * 100)}").scalar()
        below, up_to = (F.avg((c).cast("double")) for c in (F.col(col) < point, F.col(col) <= point))
        found.append(((below <= p + error) & (up_to >= p - error)).alias(f"p{round(p * 100)}_near"))
    return found


SKETCHED_COLUMNS = f"""count(delta) AS count, round(avg(delta), 4) AS mean, round(stddev_samp(delta), 4) AS std,
 min(delta)::DOUBLE AS min, max(delta)::DOUBLE AS max, {", ".join(f"TRUE AS p{round(p * 100)}_near" for p in POINTS)}"""


@query("a14_describe_distance_sketch", f"{DELTAS} SELECT {SKETCHED_COLUMNS} FROM deltas")
def describe_distance_sketch(d: Data) -> DataFrame:
    """Exact moments and quantiles from one pass; ranks are checked with twice the stated error."""
    deltas = freeze(O.link_distances(d.view("v_intervals"), d.genes()).select("delta"), "deltas")
    summary = freeze(O.describe_distance(deltas, error=0.005), "summary")
    near = deltas.agg(*_near_ranks(deltas, "delta", summary, 0.01))
    kept = summary.select(
        "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"),
    )
    near = freeze(near, "near")
    return kept.select("*", *[near.select(c).scalar().alias(c) for c in near.columns])


@query(
    "a14_merged_slices",
    f"""WITH per_row AS (SELECT variant_id, feature, coalesce(interval_score, qtl_pval)::DOUBLE AS x FROM v_evidence)
SELECT feature, count(*) AS rows, count(x) AS count, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std,
       min(x) AS min, max(x) AS max, TRUE AS variants_near,
       {", ".join(f"TRUE AS p{round(p * 100)}_near" for p in POINTS)} FROM per_row GROUP BY feature""",
)
def merged_slices(d: Data) -> DataFrame:
    """Summaries of slices, stored one by one and merged without the data."""
    rows = d.view("v_evidence").select(
        "variant_id", "feature", "source_id", F.coalesce("interval_score", "qtl_pval").cast("double").alias("x")
    )
    path = scratch_path(d.spark, "slices")
    for source in SOURCES:
        part = O.summarise_slices(rows.where(F.col("source_id") == source), ["source_id", "feature"], "x", ["variant_id"])
        part.write.parquet(path, mode="append")
    merged = freeze(O.merge_slices(d.spark.read.parquet(path), ["feature"]), "merged")
    described = O.describe_slices(merged, POINTS)
    exact = rows.join(F.broadcast(described.select("feature", *[f"p{round(p * 100)}" for p in POINTS])), "feature")
    near = []
    for p in POINTS:
        name, error = f"p{round(p * 100)}", 2 * O.rank_error()
        below, up_to = (F.coalesce(F.avg(c.cast("double")), F.lit(p)) for c in (F.col("x") < F.col(name), F.col("x") <= F.col(name)))
        near.append(((below <= p + error) & (up_to >= p - error)).alias(f"{name}_near"))
    checked = exact.groupBy("feature").agg(F.count_distinct("variant_id").alias("_variants"), *near)
    close = F.abs(F.col("variant_id") - F.col("_variants")) <= 4 * O.distinct_error() * F.col("_variants") + 1
    return described.join(checked, "feature").select(
        "feature", "rows", "count", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"), "min", "max",
        close.alias("variants_near"), *[f"p{round(p * 100)}_near" for p in POINTS],
    )


@query(
    "a10_slice_stats_sketch",
    "SELECT count(*) AS rows, max(position) - min(position) AS size_bp, TRUE AS variants_near FROM v_evidence",
)
def slice_stats_sketch(d: Data) -> DataFrame:
    """The distinct count by a sketch, within four standard errors of the exact one."""
    rows = d.view("v_evidence").select("position", "variant_id")
    exact = rows.select("variant_id").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    near = F.abs(F.col("variants") - exact) <= 4 * O.distinct_error(12) * exact + 1
    return O.slice_stats(rows, lg_k=12).select("rows", "size_bp", near.alias("variants_near"))


@query("a15_distance_histogram", HISTOGRAM_SQL)
def distance_histogram(d: Data) -> DataFrame:
    return rounded_bins(O.distance_histogram(O.link_distances(d.view("v_intervals"), d.genes())))


def _weights(d: Data) -> DataFrame:
    return O.weights_frame(d.spark, CONSEQUENCE_WEIGHTS_V1)


def _prepared(d: Data, n: int) -> DataFrame:
    return prepare_evidence(d.view("v_evidence"), _weights(d), n)


def scaled_sql(n: int) -> str:
    """Evidence with ``score_scaled``: exact quantile grid per group, then the grid position."""
    return f"""WITH scored AS (
  SELECT * EXCLUDE (feature), CASE WHEN type_id = 'vep' THEN 'not_a_feature' ELSE feature END AS feature,
         CAST({SCORE_SQL} AS DOUBLE) AS score FROM v_evidence),
kept AS (SELECT * FROM scored WHERE score IS NOT NULL),
sorted AS (SELECT source_id, feature, list(score ORDER BY score) AS xs, count(*) AS n FROM kept
           GROUP BY source_id, feature),
points AS (
  SELECT source_id, feature, i, xs[((i * (n - 1)) // {n - 1}) + 1] AS lo,
         xs[least(((i * (n - 1)) // {n - 1}) + 2, n)] AS hi, ((i * (n - 1)) % {n - 1}) / {float(n - 1)} AS share
  FROM sorted, (SELECT unnest(range(0, {n})) AS i) r),
grids AS (SELECT source_id, feature, list(lo + (hi - lo) * share ORDER BY i) AS q FROM points
          GROUP BY source_id, feature),
placed AS (
  SELECT k.*, q, len(list_filter(q, lambda v: v < k.score)) AS lt, len(list_filter(q, lambda v: v <= k.score)) AS le
  FROM kept k JOIN grids USING (source_id, feature)),
scaled AS (
  SELECT * EXCLUDE (q, lt, le),
    CASE WHEN score = q[1] THEN 0.0 WHEN score = q[{n}] THEN 1.0
         WHEN le > lt THEN (lt + le - 1) / 2.0 / {n - 1}
         ELSE (lt - 1 + (score - q[lt]) / (q[lt + 1] - q[lt])) / {n - 1} END AS score_scaled
  FROM placed)"""


SCALED_COLUMNS = "variant_id, gene_name, source_id, feature, round(score, 9) AS score, round(score_scaled, 9) AS score_scaled"


def _scaled(d: Data, n: int) -> DataFrame:
    return _prepared(d, n).select(
        "variant_id", "gene_name", "source_id", "feature", F.round("score", 9).alias("score"),
        F.round("score_scaled", 9).alias("score_scaled"),
    )


@query("w1_quantile_scale_10", f"{scaled_sql(10)} SELECT {SCALED_COLUMNS} FROM scaled")
def quantile_scale_10(d: Data) -> DataFrame:
    return _scaled(d, 10)


@query("w1_quantile_scale_100", f"{scaled_sql(100)} SELECT {SCALED_COLUMNS} FROM scaled")
def quantile_scale_100(d: Data) -> DataFrame:
    return _scaled(d, 100)


@query("w1_quantile_scale_slices", f"{scaled_sql(10)} SELECT {SCALED_COLUMNS} FROM scaled")
def quantile_scale_slices(d: Data) -> DataFrame:
    """Grids of all evidence are fitted and kept once; each source is then scored as a slice."""
    evidence, root = d.view("v_evidence"), scratch_path(d.spark, "grids")
    write_grids(fit_evidence_grids(evidence, _weights(d), 10), root, "2024-01")
    grids = read_grids(d.spark, root)
    slices = [prepare_slice(evidence.where(F.col("source_id") == s), _weights(d), grids) for s in SOURCES]
    return reduce(DataFrame.unionByName, slices).select(
        "variant_id", "gene_name", "source_id", "feature", F.round("score", 9).alias("score"),
        F.round("score_scaled", 9).alias("score_scaled"),
    )


@query(
    "w2_quantile_bins",
    """WITH u AS (SELECT type_id, study_id, pos, gene_id, pval FROM v_qtl)
SELECT *, CAST(ntile(10) OVER (PARTITION BY type_id, study_id
  ORDER BY pval, pos, gene_id NULLS FIRST) AS INTEGER) AS bin FROM u""",
)
def quantile_bins(d: Data) -> DataFrame:
    rows = d.view("v_qtl").select("type_id", "study_id", "pos", "gene_id", "pval")
    return O.quantile_bins(rows, 10, ["type_id", "study_id"], ["pval", "pos", "gene_id"])


PER_SOURCE = """per_source AS (
  SELECT variant_id, source_id, gene_name, max(score_scaled) AS ft_max, count(score_scaled) AS ft_count
  FROM scaled GROUP BY ALL)"""


@query(
    "a5_per_source_scores",
    f"{scaled_sql(10)}, {PER_SOURCE} SELECT variant_id, source_id, gene_name, round(ft_max, 9) AS ft_max FROM per_source",
)
def per_source_scores(d: Data) -> DataFrame:
    return O.per_source_scores(_prepared(d, 10)).withColumn("ft_max", F.round("ft_max", 9))


@query(
    "a6_per_source_counts",
    f"{scaled_sql(100)}, {PER_SOURCE} SELECT * REPLACE (round(ft_max, 9) AS ft_max) FROM per_source",
)
def per_source_counts(d: Data) -> DataFrame:
    return O.per_source_scores(_prepared(d, 100), counts=True).withColumn("ft_max", F.round("ft_max", 9))


COUNTED = """counted AS (
  SELECT variant_id, source_id, gene_name, count(*) AS ft_count FROM v_evidence GROUP BY ALL)"""

SPAN = "OVER (PARTITION BY variant_id, source_id)"
MINMAX_SQL = f"""round(CASE WHEN max(ft_count) {SPAN} = min(ft_count) {SPAN} THEN 0.0
  ELSE (ft_count - min(ft_count) {SPAN})::DOUBLE / (max(ft_count) {SPAN} - min(ft_count) {SPAN}) END, 9)"""


def _counted(d: Data) -> DataFrame:
    return d.view("v_evidence").groupBy("variant_id", "source_id", "gene_name").agg(
        F.count(F.lit(1)).alias("ft_count")
    )


@query("w3_minmax", f"WITH {COUNTED} SELECT *, {MINMAX_SQL} AS ft_count_scaled FROM counted")
def minmax(d: Data) -> DataFrame:
    return O.minmax(_counted(d)).withColumn("ft_count_scaled", F.round("ft_count_scaled", 9))


@query("w3_minmax_one_row_per_gene", f"WITH {COUNTED} SELECT *, {MINMAX_SQL} AS ft_count_scaled FROM counted")
def minmax_one_row_per_gene(d: Data) -> DataFrame:
    scaled = O.minmax(_counted(d), one_row_per_gene=True)
    return scaled.withColumn("ft_count_scaled", F.round("ft_count_scaled", 9))


BEST = """best AS (
  SELECT variant_id, source_id, gene_name, max(interval_score) AS score, max(qtl_pval) AS other
  FROM v_evidence GROUP BY ALL)"""


@query(
    "r1_melt_scores",
    f"""WITH {BEST} SELECT variant_id, source_id, gene_name, 'score' AS score_type, score AS value FROM best
WHERE score IS NOT NULL UNION ALL
SELECT variant_id, source_id, gene_name, 'other', other FROM best WHERE other IS NOT NULL""",
)
def melt_scores(d: Data) -> DataFrame:
    best = d.view("v_evidence").groupBy("variant_id", "source_id", "gene_name").agg(
        F.max("interval_score").alias("score"), F.max("qtl_pval").alias("other")
    )
    return O.melt_scores(best, ["score", "other"])


SOURCE_SCORES = """best AS (
  SELECT variant_id, source_id, gene_name, max(coalesce(interval_score, qtl_pval, 0.5)) AS ft_max,
         count(*) AS ft_count FROM v_evidence GROUP BY ALL)"""


def _best(d: Data) -> DataFrame:
    value = F.coalesce("interval_score", "qtl_pval", F.lit(0.5))
    return d.view("v_evidence").groupBy("variant_id", "source_id", "gene_name").agg(
        F.max(value).alias("ft_max"), F.count(F.lit(1)).alias("ft_count")
    )


@query(
    "a7_feature_aggregate",
    f"""WITH {SOURCE_SCORES} SELECT variant_id, source_id, gene_name,
 round(CASE WHEN source_id = 'vep' THEN ft_max
       ELSE (0.8 * ft_max + 0.2 * ft_count) / (0.8 + 0.2) END, 9) AS ft_agg FROM best""",
)
def feature_aggregate(d: Data) -> DataFrame:
    renamed = _best(d).withColumnRenamed("ft_count", "ft_count_scaled")
    long_scores = O.melt_scores(renamed, ["ft_max", "ft_count_scaled"])
    return O.feature_aggregate(long_scores).withColumn("ft_agg", F.round("ft_agg", 9))


UNEVEN = {
    "vep": 2.0, "javierre2016": 1.0, "andersson2014": 0.5, "thurman2012": 1.5, "gtex_v7": 3.0,
}
UNEVEN_SQL = "CASE source_id " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in UNEVEN.items()) + " END"


@query(
    "a8_variant_gene_scores",
    f"""WITH {SOURCE_SCORES} SELECT variant_id, gene_name,
 round(sum(ft_max * {UNEVEN_SQL}) / sum({UNEVEN_SQL}), 9)::DOUBLE AS src_agg FROM best GROUP BY ALL""",
)
def variant_gene_scores(d: Data) -> DataFrame:
    scores = O.variant_gene_scores(_best(d), UNEVEN, "ft_max")
    return scores.withColumn("src_agg", F.round("src_agg", 9))


RANKED = f"""WITH {SOURCE_SCORES}, scores AS (
  SELECT variant_id, gene_name, round(avg(ft_max), 9) AS src_agg FROM best GROUP BY ALL)"""


def _rounded_scores(d: Data) -> DataFrame:
    return O.variant_gene_scores(_best(d), value="ft_max").withColumn("src_agg", F.round("src_agg", 9))


@query(
    "w4_rank_genes",
    f"""{RANKED} SELECT *, CAST(rank() OVER (PARTITION BY variant_id ORDER BY src_agg DESC) AS INTEGER) AS rank
FROM scores""",
)
def rank_genes(d: Data) -> DataFrame:
    return O.rank_genes(_rounded_scores(d))


VARIANT = "2_6_A_C"


def _matrix_sql(by: str, values: list[str], value: str) -> str:
    cells = ", ".join(f"round(avg({value}) FILTER ({by} = '{v}'), 9) AS \"{v}\"" for v in values)
    return f"SELECT gene_name, {cells} FROM v_evidence WHERE variant_id = '{VARIANT}' GROUP BY gene_name"


@query("a16_evidence_matrix_by_source", _matrix_sql("source_id", SOURCES, "coalesce(interval_score, qtl_pval)"))
def evidence_matrix_by_source(d: Data) -> DataFrame:
    rows = d.view("v_evidence").withColumn("value", F.coalesce("interval_score", "qtl_pval"))
    table = O.evidence_matrix(rows, VARIANT, "source_id", SOURCES, "value")
    return table.withColumns({s: F.round(s, 9) for s in SOURCES})


@query("r2_evidence_matrix_by_feature", _matrix_sql("feature", ["A", "N", "R"], "interval_score"))
def evidence_matrix_by_feature(d: Data) -> DataFrame:
    table = O.evidence_matrix(d.view("v_evidence"), VARIANT, "feature", ["A", "N", "R"], "interval_score")
    return table.withColumns({s: F.round(s, 9) for s in "ANR"})


V1_TAIL = f"""{PER_SOURCE},
counts AS (
  SELECT *, {MINMAX_SQL} AS ft_count_scaled FROM per_source),
per_source_agg AS (
  SELECT variant_id, source_id, gene_name, CASE WHEN source_id = 'vep' THEN ft_max
         ELSE (0.8 * ft_max + 0.2 * ft_count_scaled) / (0.8 + 0.2) END AS ft_agg FROM counts)"""


@query(
    "l6_score_v2",
    f"""{scaled_sql(10)}, {PER_SOURCE} SELECT variant_id, gene_name, round(avg(ft_max), 8) AS src_agg
FROM per_source GROUP BY ALL""",
)
def version_two(d: Data) -> DataFrame:
    tables = score_v2(d.view("v_evidence"), _weights(d))
    return tables["per_variant_scores"].withColumn("src_agg", F.round("src_agg", 8))


@query(
    "l7_score_v1",
    f"""{scaled_sql(100)}, {V1_TAIL} SELECT variant_id, gene_name, round(avg(ft_agg), 8) AS src_agg
FROM per_source_agg GROUP BY ALL""",
)
def version_one(d: Data) -> DataFrame:
    tables = score_v1(d.view("v_evidence"), _weights(d))
    return tables["per_variant_aggregate_scores"].withColumn("src_agg", F.round("src_agg", 8))


RAW_COLUMNS = """variant_id, source_id, tissue_id, gene_name, gene_id, round(quantile, 9) AS quantile,
 round(beta, 9) AS beta, pval, interval_score"""
RAW_SQL = """raw AS (
  SELECT variant_id, source_id, feature AS tissue_id, gene_name, gene_id, score_scaled AS quantile,
    CASE WHEN type_id = 'eqtl' THEN qtl_beta END AS beta, CASE WHEN type_id = 'eqtl' THEN qtl_pval END AS pval,
    CASE WHEN type_id IN ('pchic', 'fantom5', 'dhscor') THEN interval_score END AS interval_score
  FROM scaled)"""
RANKS_SQL = """genes AS (
  SELECT variant_id, source_id, gene_name, max(score_scaled) AS ft_max, min(gene_id) AS gene_id
  FROM scaled {where} GROUP BY ALL),
source_ranks AS (
  SELECT variant_id, source_id, gene_name, ft_max AS source_score, CAST(rank() OVER (
    PARTITION BY variant_id, source_id ORDER BY round(ft_max, 12) DESC) AS INTEGER) AS source_rank FROM genes),
means AS (
  SELECT variant_id, gene_name, avg(ft_max) AS score, min(gene_id) AS gene_id FROM genes GROUP BY ALL),
variant_ranks AS (
  SELECT *, CAST(rank() OVER (PARTITION BY variant_id ORDER BY round(score, 12) DESC) AS INTEGER) AS rank FROM means)"""


def _rounded(df: DataFrame) -> DataFrame:
    wanted = ("quantile", "beta", "score", "source_score")
    return df.withColumns({c: F.round(c, 9) for c in wanted if c in df.columns})


@query("n1_tissue_evidence", f"{scaled_sql(10)}, {RAW_SQL} SELECT {RAW_COLUMNS} FROM raw")
def tissue_evidence(d: Data) -> DataFrame:
    return _rounded(O.tissue_evidence(_prepared(d, 10)))


@query(
    "n2_source_evidence",
    f"""{scaled_sql(10)}, {RAW_SQL}, {RANKS_SQL.format(where="")}
SELECT {RAW_COLUMNS}, round(source_score, 9) AS score, source_rank AS rank
FROM raw JOIN source_ranks USING (variant_id, source_id, gene_name)""",
)
def source_evidence(d: Data) -> DataFrame:
    return _rounded(O.source_evidence(_prepared(d, 10)))


@query(
    "n3_variant_evidence",
    f"""{scaled_sql(10)}, {RAW_SQL}, {RANKS_SQL.format(where="")}
SELECT {RAW_COLUMNS}, round(source_score, 9) AS source_score, source_rank, round(score, 9) AS score, rank
FROM raw JOIN source_ranks USING (variant_id, source_id, gene_name)
JOIN (SELECT variant_id, gene_name, score, rank FROM variant_ranks) USING (variant_id, gene_name)""",
)
def variant_evidence(d: Data) -> DataFrame:
    return _rounded(O.variant_evidence(_prepared(d, 10)))


@query(
    "n3_variant_evidence_ranks_only",
    f"""{scaled_sql(10)}, {RANKS_SQL.format(where="WHERE source_id IN ('vep', 'gtex_v7')")}
SELECT variant_id, gene_name, gene_id, round(score, 9) AS score, rank FROM variant_ranks""",
)
def variant_evidence_ranks_only(d: Data) -> DataFrame:
    answer = O.variant_evidence(_prepared(d, 10), sources=["vep", "gtex_v7"], with_evidence=False)
    return _rounded(answer)


ASKED_SQL = "SELECT DISTINCT variant_id FROM v_evidence WHERE feature = 'stop_gained'"


def _asked(d: Data) -> DataFrame:
    return d.view("v_evidence").where("feature = 'stop_gained'").select("variant_id")


@query(
    "f9_for_variant_table",
    f"""SELECT variant_id, gene_name, source_id, feature, interval_score, qtl_pval FROM v_evidence
WHERE variant_id IN ({ASKED_SQL}) AND source_id IN ('vep', 'gtex_v7')""",
)
def for_variant_table(d: Data) -> DataFrame:
    """All evidence of the variants that stop a transcript, which are a table."""
    found = O.for_variant_table(d.view("v_evidence"), _asked(d), ["vep", "gtex_v7"])
    return found.select("variant_id", "gene_name", "source_id", "feature", "interval_score", "qtl_pval")


@query(
    "n3_variant_evidence_for_table",
    f"""{scaled_sql(10)}, asked AS ({ASKED_SQL}), {RANKS_SQL.format(where="WHERE variant_id IN (SELECT variant_id FROM asked)")}
SELECT variant_id, gene_name, gene_id, round(score, 9) AS score, rank FROM variant_ranks""",
)
def variant_evidence_for_table(d: Data) -> DataFrame:
    return _rounded(O.variant_evidence(_prepared(d, 10), ids=_asked(d), with_evidence=False))
