"""Whole jobs, from raw rows to results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink import plans as P
from regulink import sources as S
from regulink.session import scratch_path
from workload.columns import LABELS_SQL, QTL_OUT, SIGNIFICANT, TSS_SQL
from workload.joins import CONCORDANCE, COVERAGE, LAST_SYMBOL, lift_sql
from workload.scoring import DESCRIBE_SQL, HISTOGRAM_SQL, rounded_bins, rounded_summary
from workload.registry import query
from workload.views import Data

QTL_SQL = f"SELECT {QTL_OUT.format(feature='bio_feature')} FROM v_qtl WHERE {SIGNIFICANT} AND gene_id IS NOT NULL"


@query("l1_build_qtl", QTL_SQL)
def build_qtl(d: Data) -> DataFrame:
    return P.build_qtl(d.view("v_qtl"))


@query("l1_write_qtl", QTL_SQL)
def write_qtl(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "qtl")
    P.write_qtl(d.view("v_qtl"), path)
    return d.spark.read.schema(P.build_qtl(d.view("v_qtl")).schema).parquet(path)


@query(
    "l1_write_qtl_feature_list",
    f"""SELECT DISTINCT type_id AS source, concat_ws('-', study_id, bio_feature) AS feature
FROM v_qtl WHERE {SIGNIFICANT} AND gene_id IS NOT NULL""",
)
def write_qtl_feature_list(d: Data) -> DataFrame:
    path = scratch_path(d.spark, "qtl-composite")
    P.write_qtl(d.view("v_qtl"), path, composite=True)
    return d.spark.read.schema("source string, feature string").json(path + ".feature_list.json")


LINK_OUT = 'chrom, start_pos AS start, end_pos AS "end", gene_id, score, bio_feature'


@query(
    "l2_build_gene_list_links",
    f"""WITH official AS MATERIALIZED (SELECT DISTINCT gene_name FROM v_genes),
other AS MATERIALIZED (SELECT unnest(string_split(synonyms, ';')) AS gene_name, gene_id FROM v_genes),
names AS MATERIALIZED (
  SELECT gene_name, gene_id FROM v_genes UNION ALL
  SELECT o.gene_name, o.gene_id FROM other o LEFT JOIN official f ON o.gene_name = f.gene_name WHERE f.gene_name IS NULL),
listed AS MATERIALIZED (
  SELECT chrom, start_pos, end_pos, concat('CODE_', bio_feature) AS bio_feature,
         unnest([gene_name, other_name]) AS gene_name FROM v_links),
named AS MATERIALIZED (SELECT chrom, start_pos, end_pos, gene_id, bio_feature FROM listed JOIN names USING (gene_name)),
{lift_sql("named", "gene_id, bio_feature")},
cis AS MATERIALIZED (
  SELECT lifted.*, 1.0::DOUBLE AS score,
         abs((start_pos + end_pos) / 2 - (g.gene_start + g.gene_end) / 2) AS distance
  FROM lifted JOIN v_genes g USING (gene_id) WHERE chrom = g.gene_chrom)
SELECT {LINK_OUT} FROM cis WHERE distance <= 2 * (SELECT stddev_samp(distance) FROM cis)""",
    materialized=True,
)
def build_gene_list_links(d: Data) -> DataFrame:
    blocks = S.parse_chain(d.view("v_chain_lines"))
    return P.build_gene_list_links(d.sql("SELECT * FROM v_gene_lists"), d.genes(), d.view("v_labels"), blocks)


@query(
    "l3_build_capture_links",
    f"""WITH tss AS ({TSS_SQL} AND biotype = 'protein_coding'), pairs AS (
  SELECT l.chrom, l.start_pos + 1 AS start_pos, l.end_pos, t.name AS gene_id, l.score, l.bio_feature
  FROM v_links l JOIN tss t ON l.gene_chrom = t.chrom AND l.gene_start - 1000 < t."end"
       AND t.start < l.gene_start + 2000
  WHERE l.chrom = t.chrom AND abs((l.start_pos + l.end_pos) / 2 - t.start) < 2450000),
best AS MATERIALIZED (SELECT chrom, start_pos, end_pos, gene_id, bio_feature, max(score) AS score FROM pairs GROUP BY ALL),
{lift_sql("best", "gene_id, score, concat('CODE_', bio_feature) AS bio_feature")}
SELECT {LINK_OUT} FROM lifted""",
)
def build_capture_links(d: Data) -> DataFrame:
    tss = P.gene_tss(S.parse_gtf(d.view("v_gtf_lines")))
    blocks = S.parse_chain(d.view("v_chain_lines"))
    return P.build_capture_links(d.view("v_baits"), tss, d.view("v_labels"), blocks)


@query(
    "l4_build_enhancer_links",
    f"""WITH near AS (
  SELECT l.chrom, l.start_pos, l.end_pos, g.gene_id, l.score * l.score AS score
  FROM v_links l JOIN v_genes g ON l.gene_name = g.gene_name
  WHERE l.chrom = g.gene_chrom AND abs((l.start_pos + l.end_pos) / 2 - g.tss) < 2 * 534132.8),
best AS MATERIALIZED (SELECT chrom, start_pos + 1 AS start_pos, end_pos, gene_id, round(max(score), 6) AS score
         FROM near GROUP BY ALL),
{lift_sql("best", "gene_id, score, 'unspecified' AS bio_feature")}
SELECT {LINK_OUT} FROM lifted""",
)
def build_enhancer_links(d: Data) -> DataFrame:
    blocks = S.parse_chain(d.view("v_chain_lines"))
    links = P.build_enhancer_links(d.view("v_packed"), d.genes(), blocks)
    return links.withColumn("score", F.round("score", 6))


@query(
    "l5_build_correlation_links",
    f"""WITH {LAST_SYMBOL}, best AS MATERIALIZED (
  SELECT l.chrom, l.start_pos + 1 AS start_pos, l.end_pos, m.gene_id, max(l.score) AS score
  FROM v_links l JOIN last_line m ON l.gene_name = m.gene_symbol GROUP BY ALL),
{lift_sql("best", "gene_id, score, 'unspecified' AS bio_feature")}
SELECT {LINK_OUT} FROM lifted""",
)
def build_correlation_links(d: Data) -> DataFrame:
    rows = d.view("v_links").select(
        F.concat(F.lit("chr"), "chrom").alias("chrom"), "start", "end",
        F.lower("gene_name").alias("gene_symbol"), "score",
    )
    gtf = S.parse_gtf(d.view("v_gtf_lines"))
    return P.build_correlation_links(rows, gtf, S.parse_chain(d.view("v_chain_lines")))


@query(
    "l8_build_biofeature_map",
    f"""WITH labels AS (
  SELECT original_source, study, biofeature_string, biofeature_code, NULL::VARCHAR AS biofeature_ontology_term,
         label, NULL::VARCHAR AS tissue_label, NULL::VARCHAR AS condition_label FROM v_other_labels
  UNION ALL {LABELS_SQL} WHERE quant_method IN ('ge', 'microarray'))
SELECT * FROM labels UNION ALL
SELECT 'composite_source_feature_hack', study, study || '-' || biofeature_string,
       study || '-' || biofeature_code, biofeature_ontology_term, label, tissue_label, condition_label
FROM labels WHERE study IS NOT NULL""",
)
def build_biofeature_map(d: Data) -> DataFrame:
    return P.build_biofeature_map(d.view("v_meta"), d.view("v_other_labels"))


@query(
    "l9_nearest_check",
    f"{CONCORDANCE} SELECT count(*) AS variants, count(*) FILTER (mismatch) AS mismatches FROM compared",
)
def nearest_check(d: Data) -> DataFrame:
    return P.nearest_check(
        d.view("v_nearest"), d.view("v_annotated"), variant_order=["ensemblid_protein_coding"]
    )


@query(
    "l9_coverage_check",
    f"""{COVERAGE} SELECT count(*) AS genes, count(*) FILTER (qtl_gene) AS qtl_gene,
 count(*) FILTER (link_gene) AS link_gene FROM covered""",
)
def coverage_check(d: Data) -> DataFrame:
    _, summary = P.coverage_check(
        d.genes(),
        qtl_gene=d.view("v_qtl"),
        link_gene=d.view("v_intervals"),
    )
    return summary


@query("l9_distance_check", DESCRIBE_SQL)
def distance_check(d: Data) -> DataFrame:
    return rounded_summary(P.distance_check(d.view("v_intervals"), d.genes())[0])


@query("l9_distance_histogram", HISTOGRAM_SQL)
def distance_check_histogram(d: Data) -> DataFrame:
    return rounded_bins(P.distance_check(d.view("v_intervals"), d.genes())[1])


@query("l10_gene_tss", TSS_SQL + " AND biotype = 'protein_coding'")
def gene_tss(d: Data) -> DataFrame:
    return P.gene_tss(S.parse_gtf(d.view("v_gtf_lines")))


