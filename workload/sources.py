"""Readers, parsers and writers: data derived from the tables is written, read and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regulink import sources as S
from regulink.fixed_values import CONSEQUENCE_WEIGHTS_V1
from regulink.operators import bonferroni, weights_frame
from regulink.session import freeze, scratch_path
from regulink.sources.writers import range_sorted
from workload.registry import query
from workload.views import Data

LINKS_SQL = """SELECT chrom, start_pos AS start, end_pos AS "end", gene_id, score, bio_feature
FROM v_intervals"""


def _out(d: Data, label: str) -> str:
    return scratch_path(d.spark, label)


@query("s1_read_intervals", LINKS_SQL)
def read_intervals(d: Data) -> DataFrame:
    path = _out(d, "intervals")
    S.write_tsv(d.view("v_intervals").withColumnRenamed("bio_feature", "cell_type"), path)
    return S.read_intervals(d.spark, path)


@query("s2_read_sumstats", "SELECT * FROM v_qtl")
def read_sumstats(d: Data) -> DataFrame:
    path = _out(d, "sumstats")
    d.view("v_qtl").write.parquet(path)
    return S.read_sumstats(d.spark, path)


@query(
    "s3_read_genes",
    """SELECT gene_id, gene_name, synonyms, gene_chrom, gene_start, gene_end, gene_chrom AS chr,
       CAST(NULL AS BIGINT) AS start, tss, biotype, description FROM v_genes""",
)
def read_genes(d: Data) -> DataFrame:
    path = _out(d, "genes")
    S.write_jsonl(d.genes(), path)
    genes = S.read_genes(d.spark, path)
    return genes.withColumn("synonyms", F.array_join("gene_synonyms", ";")).drop("gene_synonyms")


@query(
    "s4_read_biofeatures",
    """SELECT 'meta' AS original_source, study, qtl_group AS biofeature_string,
       upper(qtl_group) AS biofeature_code, CAST(NULL AS VARCHAR) AS biofeature_ontology_term,
       CAST(NULL AS VARCHAR) AS label, tissue_label, condition_label FROM v_meta
UNION ALL
SELECT original_source, study, biofeature_string, biofeature_code, NULL, label, NULL, NULL
FROM v_other_labels""",
)
def read_biofeatures(d: Data) -> DataFrame:
    first, second = _out(d, "labels"), _out(d, "labels")
    S.write_jsonl(
        d.view("v_meta").selectExpr(
            "'meta' AS original_source", "study", "qtl_group AS biofeature_string",
            "upper(qtl_group) AS biofeature_code", "tissue_label", "condition_label",
        ),
        first,
    )
    S.write_jsonl(d.view("v_other_labels"), second)
    return S.read_biofeatures(d.spark, [first, second])


GTF_SQL = """
WITH lines AS (
  SELECT p_partkey, gene_chrom, gene_start, gene_end, strand, k,
         CASE WHEN k = 0 THEN 'gene' ELSE 'transcript' END AS feature,
         concat('gene_id "', gene_id, '"; gene_name "',
                CASE WHEN p_partkey % 4 = 0 THEN lower(gene_name) ELSE gene_name END,
                CASE WHEN k = 0 THEN '"; gene_biotype "' ELSE '"; transcript_biotype "' END,
                biotype, '";') AS attributes
  FROM v_genes, (SELECT unnest([0, 1, 2]) AS k) copies
)"""


@query(
    "s5_parse_gtf",
    GTF_SQL
    + """ SELECT CAST(p_partkey AS BIGINT) * 10 + k AS line_no, gene_chrom AS seqname, 'src' AS source,
       feature, gene_start AS start, gene_end AS "end", '.' AS score, strand, '.' AS frame, attributes
FROM lines""",
)
def parse_gtf(d: Data) -> DataFrame:
    return S.parse_gtf(d.view("v_gtf_lines"))


@query(
    "s5_read_gtf",
    GTF_SQL
    + """ SELECT gene_chrom AS seqname, feature, gene_start AS start, gene_end AS "end", strand, attributes
FROM lines""",
)
def read_gtf(d: Data) -> DataFrame:
    path = _out(d, "gtf")
    d.view("v_gtf_lines").select("value").write.text(path, compression="gzip")
    return S.read_gtf(d.spark, path).select(
        "seqname", "feature", "start", "end", "strand", "attributes"
    )


@query(
    "s6_parse_vcf_sites",
    """SELECT CAST(l_suppkey % 5 + 1 AS VARCHAR) AS chrom, l_orderkey * 1000 + l_linenumber AS pos,
       'A' AS ref, CASE WHEN l_linenumber % 3 = 0 THEN 'C,G' ELSE 'T' END AS alt FROM {lineitem}""",
)
def parse_vcf_sites(d: Data) -> DataFrame:
    return S.parse_vcf_sites(d.view("v_vcf_lines"))


@query("s7_parse_chain", "SELECT * FROM v_blocks")
def parse_chain(d: Data) -> DataFrame:
    return S.parse_chain(d.view("v_chain_lines"))


@query("s7_read_chain", "SELECT * FROM v_blocks")
def read_chain(d: Data) -> DataFrame:
    path = _out(d, "chain")
    d.view("v_chain_lines").write.text(path, lineSep="\n\n")
    return S.read_chain(d.spark, path)


@query("s8_read_links_csv", "SELECT * FROM v_gene_lists")
def read_links_csv(d: Data) -> DataFrame:
    path = _out(d, "gene-lists")
    d.view("v_gene_lists").write.csv(path, header=True)
    return S.read_links_csv(d.spark, path)


@query(
    "s9_read_bed",
    """SELECT gene_chrom AS chrom, gene_start - 1000 AS start, gene_start + 2000 AS "end",
       concat('chr', chrom, ':', CAST(start_pos AS VARCHAR), '-', CAST(end_pos AS VARCHAR), ',',
              CAST(score AS VARCHAR)) AS target FROM v_links""",
)
def read_bed(d: Data) -> DataFrame:
    path = _out(d, "bed")
    lines = d.view("v_baits").selectExpr(
        r"concat_ws('\t', substring(chrom, 4), start, end, target, 'x') AS value"
    )
    headers = d.table("region").selectExpr("concat('track name=', r_name) AS value")
    lines.unionByName(headers).write.text(path)
    columns = {
        "chrom": (0, "string"), "start": (1, "long"), "end": (2, "long"), "target": (3, "string"),
    }
    return S.read_bed(d.spark, path, columns)


@query(
    "s10_read_evidence",
    """SELECT position, variant_id, gene_name, gene_id, feature, type_id, source_id, qtl_beta, qtl_pval,
       interval_score FROM v_evidence""",
)
def read_evidence(d: Data) -> DataFrame:
    path = _out(d, "evidence")
    null_text, null_number = "CAST(NULL AS STRING)", "CAST(NULL AS DOUBLE)"
    d.view("v_evidence").selectExpr(
        "split_part(variant_id, '_', 1) AS chr_id", "position", "'A' AS ref_allele", "'C' AS alt_allele",
        "variant_id", f"{null_text} AS rs_id", f"{null_text} AS gene_chr", "gene_id",
        f"{null_number} AS gene_start", f"{null_number} AS gene_end", "gene_name", "feature", "type_id",
        "source_id", f"{null_text} AS csq_counts", "qtl_beta", f"{null_number} AS qtl_se", "qtl_pval",
        "interval_score",
    ).write.csv(path, sep="\t", compression="gzip")
    return S.read_evidence(d.spark, path).select(
        "position", "variant_id", "gene_name", "gene_id", "feature", "type_id", "source_id",
        "qtl_beta", "qtl_pval", "interval_score",
    )


@query(
    "s11_read_consequences",
    """SELECT feature AS term, count(*) AS n, CAST(CASE feature WHEN 'missense_variant' THEN 0.7
       WHEN 'stop_gained' THEN 0.95 ELSE 0.65 END AS DOUBLE) AS weight
FROM v_evidence WHERE type_id = 'vep' GROUP BY feature""",
)
def read_consequences(d: Data) -> DataFrame:
    path = _out(d, "consequences")
    weights = weights_frame(d.spark, CONSEQUENCE_WEIGHTS_V1)
    S.write_tsv(weights.selectExpr("term AS `SO term`", "weight AS v2g_score"), path)
    table = S.read_consequences(d.spark, path, "SO term", "v2g_score")
    used = d.view("v_evidence").where("type_id = 'vep'").groupBy(F.col("feature").alias("term"))
    return used.agg(F.count(F.lit(1)).alias("n")).join(table, "term")


@query("s12_write_sorted", LINKS_SQL)
def write_sorted(d: Data) -> DataFrame:
    path = S.dataset_path(_out(d, "out"), "interval", "pchic", "synthetic", "1")
    S.write_sorted(d.view("v_intervals"), path)
    return d.spark.read.parquet(path)


@query("s13_write_partitioned", "SELECT type_id AS type, * EXCLUDE (type_id) FROM v_qtl")
def write_partitioned(d: Data) -> DataFrame:
    path = _out(d, "partitioned")
    qtl = d.view("v_qtl").withColumnRenamed("type_id", "type")
    S.write_partitioned(qtl, path)
    return d.spark.read.schema(qtl.schema).parquet(path)


@query(
    "s14_write_tsv",
    """SELECT chrom, CAST(start_pos AS VARCHAR) AS start, CAST(end_pos AS VARCHAR) AS "end", gene_id
FROM v_intervals""",
)
def write_tsv(d: Data) -> DataFrame:
    path = _out(d, "tsv")
    S.write_tsv(d.view("v_intervals"), path)
    return d.spark.read.csv(path, sep="\t", header=True).select("chrom", "start", "end", "gene_id")


@query("s15_write_jsonl", "SELECT type_id, study_id, gene_id, pos, pval FROM v_qtl")
def write_jsonl(d: Data) -> DataFrame:
    path = _out(d, "jsonl")
    rows = d.view("v_qtl").select("type_id", "study_id", "gene_id", "pos", "pval")
    S.write_jsonl(rows, path)
    return d.spark.read.schema(rows.schema).json(path)


@query(
    "p22_tag_from_path",
    """SELECT bio_feature AS cell, chrom, start_pos AS start, end_pos AS "end" FROM v_intervals""",
)
def tag_from_path(d: Data) -> DataFrame:
    path = _out(d, "cells")
    d.view("v_intervals").selectExpr(
        r"concat_ws('\t', chrom, start, end) AS value", "bio_feature AS cell"
    ).write.partitionBy("cell").text(path)
    columns = {"chrom": (0, "string"), "start": (1, "long"), "end": (2, "long")}
    return S.read_bed(d.spark, f"{path}/cell=*", columns, tag={"cell": "/cell=([^/]+)/"})


def _order_report(ordered: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by chromosome, and how many of them come before the row ahead of them."""
    placed = ordered.select(
        F.struct(*keys).alias("key"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    )
    placed = freeze(placed, "order")
    before = F.lag("key").over(Window.partitionBy("part").orderBy("at"))
    parts = placed.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    parts = parts.select("part", F.max("high").over(earlier).alias("reached"))
    behind = F.coalesce(F.coalesce("before", "reached") > F.col("key"), F.lit(False))
    return (
        placed.withColumn("before", before)
        .join(parts, "part")
        .groupBy("key.chrom")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(behind.cast("long")).alias("out_of_order"))
    )


@query("o1_range_sort", "SELECT chrom, count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM v_intervals GROUP BY chrom")
def range_sort(d: Data) -> DataFrame:
    keys = ["chrom", "start", "end"]
    return _order_report(range_sorted(d.view("v_intervals"), keys, 6), keys)


@query("o2_position_sort", "SELECT chrom, count(*) AS n, CAST(0 AS BIGINT) AS out_of_order FROM v_qtl GROUP BY chrom")
def position_sort(d: Data) -> DataFrame:
    keys = ["chrom", "pos"]
    return _order_report(range_sorted(d.view("v_qtl"), keys, 6), keys)


@query(
    "o3_row_cap",
    """SELECT chrom, pos, gene_id, pval FROM v_qtl
WHERE pval <= 0.05 / nullif(num_tests, 0) ORDER BY pval, chrom, pos, gene_id LIMIT 100""",
)
def row_cap(d: Data) -> DataFrame:
    kept = bonferroni(d.view("v_qtl")).select("chrom", "pos", "gene_id", "pval")
    return kept.orderBy("pval", "chrom", "pos", F.col("gene_id").asc_nulls_last()).limit(100)
