"""Genomic-looking views derived from the given tables.

One SQL text per view, valid both in Spark and in DuckDB; ``{table}`` stands for a given table.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from regulink.session import tune

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def _text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR(20))"


VIEWS = {
    "v_genes": f"""
SELECT p_partkey,
       concat('G', {_text("p_partkey")}) AS gene_id,
       concat('SYM', {_text("p_partkey - p_partkey % 3")}) AS gene_name,
       concat('ALT', {_text("p_partkey - p_partkey % 2")},
              ';SYM', {_text("p_partkey + 30 - p_partkey % 3")}) AS synonyms,
       {_text("p_partkey % 5 + 1")} AS gene_chrom,
       p_partkey * 5000 AS gene_start,
       p_partkey * 5000 + p_size * 1000 AS gene_end,
       CASE WHEN p_partkey % 50 = 0 THEN '.' WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand,
       CASE WHEN p_size % 2 = 0 THEN p_partkey * 5000 ELSE p_partkey * 5000 + p_size * 1000 END AS tss,
       CASE WHEN p_size % 3 = 0 THEN 'lincRNA' ELSE 'protein_coding' END AS biotype,
       p_name AS description
FROM {{part}}""",
    "v_links": f"""
SELECT DISTINCT {_text("l_suppkey % 5 + 1")} AS chrom,
       l_partkey * 5000 + (l_orderkey % 401) * 2000 AS start_pos,
       l_partkey * 5000 + (l_orderkey % 401) * 2000 + CAST(l_quantity AS BIGINT) * 200 AS end_pos,
       concat('G', {_text("l_partkey")}) AS gene_id,
       concat('SYM', {_text("l_partkey - l_partkey % 3")}) AS gene_name,
       concat('ALT', {_text("l_partkey - l_partkey % 2")}) AS other_name,
       l_partkey * 5000 AS gene_start,
       {_text("l_partkey % 5 + 1")} AS gene_chrom,
       l_discount AS score, l_returnflag AS bio_feature
FROM {{lineitem}}""",
    "v_intervals": """
SELECT chrom, start_pos, end_pos, gene_id, score, bio_feature FROM v_links""",
    "v_repeated": f"""
SELECT {_text("l_suppkey % 5 + 1")} AS chrom, l_partkey * 5000 AS start_pos,
       l_partkey * 5000 + 5000 AS end_pos, concat('G', {_text("l_partkey")}) AS gene_id,
       l_discount AS score
FROM {{lineitem}}""",
    "v_qtl": f"""
SELECT CASE WHEN l_linestatus = 'O' THEN 'eqtl' ELSE 'pqtl' END AS type_id,
       concat('STUDY', {_text("l_suppkey % 4")}) AS study_id,
       l_returnflag AS bio_feature,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('G', {_text("l_partkey")}) END AS gene_id,
       {_text("l_suppkey % 5 + 1")} AS chrom,
       l_orderkey * 1000 + l_linenumber AS pos, 'A' AS ref, 'C' AS alt,
       l_discount - 0.05 AS beta, l_tax AS se, l_extendedprice / 100000000.0 AS pval,
       CAST(l_quantity AS BIGINT) * 10 - 10 AS num_tests
FROM {{lineitem}}""",
    "v_cis_qtl": f"""
SELECT concat('G', {_text("l_partkey")}) AS gene_id,
       {_text("l_suppkey % 5 + 1")} AS chrom,
       l_partkey * 5000 + (l_orderkey % 1000 - 500) * 4000 AS pos,
       CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice / 2000000000.0
            ELSE l_extendedprice / 1000000000000.0 END AS pval
FROM {{lineitem}}""",
    "v_evidence": f"""
SELECT concat({_text("l_suppkey % 5 + 1")}, '_', {_text("l_orderkey % 500")}, '_A_C') AS variant_id,
       l_orderkey % 500 AS position,
       concat('SYM', {_text("l_partkey % 20")}) AS gene_name,
       concat('G', {_text("l_partkey % 20")}) AS gene_id,
       CASE l_linenumber % 5 WHEN 0 THEN 'vep' WHEN 1 THEN 'pchic' WHEN 2 THEN 'fantom5'
            WHEN 3 THEN 'dhscor' ELSE 'eqtl' END AS type_id,
       CASE l_linenumber % 5 WHEN 0 THEN 'vep' WHEN 1 THEN 'javierre2016' WHEN 2 THEN 'andersson2014'
            WHEN 3 THEN 'thurman2012' ELSE 'gtex_v7' END AS source_id,
       CASE WHEN l_linenumber % 5 = 0 THEN
              (CASE l_returnflag WHEN 'A' THEN 'missense_variant' WHEN 'N' THEN 'stop_gained'
                    ELSE 'intron_variant' END)
            ELSE l_returnflag END AS feature,
       CASE WHEN l_linenumber % 5 = 4 THEN l_discount - 0.05 ELSE NULL END AS qtl_beta,
       CASE WHEN l_linenumber % 5 = 4 THEN l_tax ELSE NULL END AS qtl_pval,
       CASE WHEN l_linenumber % 5 IN (1, 2, 3) THEN l_discount ELSE NULL END AS interval_score
FROM {{lineitem}}""",
    "v_gtf_lines": f"""
SELECT CAST(p_partkey AS BIGINT) * 10 + k AS line_no,
       concat(gene_chrom, chr(9), 'src', chr(9), CASE WHEN k = 0 THEN 'gene' ELSE 'transcript' END,
              chr(9), {_text("gene_start")}, chr(9), {_text("gene_end")}, chr(9), '.', chr(9), strand,
              chr(9), '.', chr(9), 'gene_id "', gene_id, '"; gene_name "',
              CASE WHEN p_partkey % 4 = 0 THEN lower(gene_name) ELSE gene_name END,
              CASE WHEN k = 0 THEN '"; gene_biotype "' ELSE '"; transcript_biotype "' END,
              biotype, '";') AS value
FROM (SELECT *, 0 AS k FROM v_genes UNION ALL SELECT *, 1 AS k FROM v_genes
      UNION ALL SELECT *, 2 AS k FROM v_genes) g
UNION ALL
SELECT CAST(-r_regionkey AS BIGINT) AS line_no, concat('#!', r_name) AS value FROM {{region}}""",
    "v_vcf_lines": f"""
SELECT concat({_text("l_suppkey % 5 + 1")}, chr(9), {_text("l_orderkey * 1000 + l_linenumber")}, chr(9),
              'rs', {_text("l_orderkey")}, chr(9), 'A', chr(9),
              CASE WHEN l_linenumber % 3 = 0 THEN 'C,G' ELSE 'T' END, chr(9), '.') AS value
FROM {{lineitem}}
UNION ALL SELECT concat('##', r_name) AS value FROM {{region}}""",
    "v_chains": """
SELECT CAST(s_suppkey AS BIGINT) AS k, 1000 + s_suppkey % 7 * 10 AS score,
       CAST(s_suppkey % 5 + 1 AS VARCHAR(20)) AS src_chrom,
       CAST(FLOOR(s_suppkey / 5) AS BIGINT) * 1500000 AS src_from,
       CASE WHEN s_suppkey % 6 = 5 THEN 'chrUn' ELSE
         concat('chr', CAST((s_suppkey + CAST(FLOOR(s_suppkey / 5) AS BIGINT)) % 5 + 1 AS VARCHAR(20)))
         END AS tgt_chrom,
       CASE WHEN s_suppkey % 3 = 0 THEN '-' ELSE '+' END AS tgt_strand,
       CAST(FLOOR(s_suppkey / 5) AS BIGINT) * 1500000 + 77 AS tgt_from
FROM {supplier}""",
    "v_chain_lines": """
SELECT concat('chain ', CAST(score AS VARCHAR(20)), ' ', src_chrom, ' 2000000000 + ',
              CAST(src_from AS VARCHAR(20)), ' ', CAST(src_from + 1901500 AS VARCHAR(20)), ' ', tgt_chrom,
              ' 2000000000 ', tgt_strand, ' ', CAST(tgt_from AS VARCHAR(20)), ' ',
              CAST(tgt_from + 1900000 + 50 * k AS VARCHAR(20)), ' ', CAST(k AS VARCHAR(20)), chr(10),
              '600000', chr(9), '1000', chr(9), CAST(50 * k AS VARCHAR(20)), chr(10),
              '500000', chr(9), '500', chr(9), '0', chr(10), '800000') AS value
FROM v_chains""",
    "v_blocks": """
SELECT k AS chain_id, CAST(score AS BIGINT) AS score, src_chrom,
       src_from + src_off AS src_start, src_from + src_off + size AS src_end, tgt_chrom,
       CAST(2000000000 AS BIGINT) AS tgt_size, tgt_strand, tgt_from + tgt_off AS tgt_start
FROM (
  SELECT *, 0 AS src_off, 600000 AS size, 0 AS tgt_off FROM v_chains
  UNION ALL SELECT *, 601000 AS src_off, 500000 AS size, 600000 + 50 * k AS tgt_off FROM v_chains
  UNION ALL SELECT *, 1101500 AS src_off, 800000 AS size, 1100000 + 50 * k AS tgt_off FROM v_chains
) b""",
    "v_packed": """
SELECT concat('chr', chrom, ':', CAST(start_pos AS VARCHAR(20)), '-', CAST(end_pos AS VARCHAR(20)),
              ';NM_1;', lower(gene_name), ';R:', CAST(score AS VARCHAR(20)), ';0.01') AS name
FROM v_links""",
    "v_gene_lists": """
SELECT concat(gene_name, ';', other_name) AS gene_names,
       concat('chr', chrom, '.', CAST(start_pos AS VARCHAR(20)), '.', CAST(end_pos AS VARCHAR(20)))
         AS "interval",
       bio_feature AS biofeature_string
FROM v_links""",
    "v_baits": """
SELECT concat('chr', gene_chrom) AS chrom, gene_start - 1000 AS start_pos, gene_start + 2000 AS end_pos,
       concat('chr', chrom, ':', CAST(start_pos AS VARCHAR(20)), '-', CAST(end_pos AS VARCHAR(20)), ',',
              CAST(score AS VARCHAR(20))) AS target,
       bio_feature
FROM v_links""",
    "v_meta": """
SELECT CASE c_custkey % 3 WHEN 0 THEN 'GTEx' WHEN 1 THEN 'Alasoo_2018' ELSE 'TwinsUK' END AS study,
       concat(lower(c_mktsegment), '_', CAST(c_nationkey AS VARCHAR(20))) AS qtl_group,
       concat('UBERON_', CAST(c_nationkey AS VARCHAR(20))) AS tissue_ontology_id,
       concat(lower(c_mktsegment), '_tissue') AS tissue_label,
       CASE WHEN c_custkey % 2 = 0 THEN 'naive' WHEN c_custkey % 7 = 0 THEN NULL ELSE 'IFNg_18h' END
         AS condition_label,
       c_custkey AS sample_size,
       CASE c_custkey % 4 WHEN 0 THEN 'ge' WHEN 1 THEN 'microarray' WHEN 2 THEN 'exon' ELSE 'tx' END
         AS quant_method
FROM {customer}""",
    "v_other_labels": """
SELECT 'manual' AS original_source,
       CASE WHEN s_suppkey % 2 = 0 THEN concat('STUDY', CAST(s_suppkey % 4 AS VARCHAR(20))) ELSE NULL END
         AS study,
       s_name AS biofeature_string,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE concat('CODE_', CAST(s_suppkey AS VARCHAR(20))) END
         AS biofeature_code,
       s_name AS label
FROM {supplier}""",
    "v_labels": """
SELECT DISTINCT bio_feature AS biofeature_string, concat('CODE_', bio_feature) AS biofeature_code
FROM v_links""",
    "v_remap": """
SELECT DISTINCT concat('NEW_', study_id) AS study_id, concat(bio_feature, '_new') AS biofeature_code,
       study_id AS old_study_id, bio_feature AS old_bio_feature_code
FROM v_qtl WHERE study_id <> 'STUDY3'
UNION ALL
SELECT DISTINCT 'NEW_OTHER' AS study_id, 'second' AS biofeature_code,
       study_id AS old_study_id, bio_feature AS old_bio_feature_code
FROM v_qtl WHERE study_id = 'STUDY1' AND bio_feature = 'A'""",
    "v_nearest": """
SELECT concat(chrom, '_', CAST(pos AS VARCHAR(20)), '_A_C') AS varid,
       coalesce(gene_id, 'none') AS ensemblid_protein_coding
FROM v_qtl""",
    "v_annotated": """
SELECT concat(chrom, ':', CAST(pos AS VARCHAR(20))) AS loc,
       concat('IMPACT=LOW;NEAREST=', CASE WHEN pos % 3 = 0 THEN 'G0' ELSE coalesce(gene_id, 'none') END)
         AS info
FROM v_qtl""",
}


def _views_in(text: str) -> list[str]:
    """Views a text names, each after those it needs."""
    found: list[str] = []
    for name in re.findall(r"\bv_\w+", text):
        if name in VIEWS and name not in found:
            for needed in [*_views_in(VIEWS[name]), name]:
                if needed not in found:
                    found.append(needed)
    return found


@cache
def with_views(text: str, materialized: bool = False) -> str:
    """Put the views a query names in front of it; further ``WITH`` parts of the query follow."""
    kind = "AS MATERIALIZED" if materialized else "AS"
    parts = [f"{name} {kind} ({VIEWS[name]})" for name in _views_in(text)]
    body = text.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(parts)}, {body[5:]}" if parts else body
    return f"WITH {', '.join(parts)} {body}" if parts else body


def duckdb_sql(text: str, materialized: bool = False) -> str:
    sql = with_views(text, materialized)
    for table in TABLES:
        sql = sql.replace("{" + table + "}", table)
    return sql


class Data:
    """The given tables of one scale, and the views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def links(self) -> DataFrame:
        """The rows of ``v_links``, told apart by the columns that all others are functions of.

        Names and the place of the gene follow from its key, and are added when repeats are dropped, so
        that they are neither held nor shuffled for that.
        """
        keys = self.table("lineitem").selectExpr(
            "l_suppkey % 5 + 1 AS chrom",
            "l_partkey * 5000 + (l_orderkey % 401) * 2000 AS start_pos",
            "l_partkey * 5000 + (l_orderkey % 401) * 2000 + CAST(l_quantity AS BIGINT) * 200 AS end_pos",
            "l_partkey", "l_discount AS score", "l_returnflag AS bio_feature",
        )
        return keys.distinct().selectExpr(
            f"{_text('chrom')} AS chrom", "start_pos", "end_pos",
            f"concat('G', {_text('l_partkey')}) AS gene_id",
            f"concat('SYM', {_text('l_partkey - l_partkey % 3')}) AS gene_name",
            f"concat('ALT', {_text('l_partkey - l_partkey % 2')}) AS other_name",
            "l_partkey * 5000 AS gene_start", f"{_text('l_partkey % 5 + 1')} AS gene_chrom",
            "score", "bio_feature",
        )

    def sql(self, text: str) -> DataFrame:
        query = with_views(text).replace('"interval"', "`interval`")
        inputs = {}
        if VIEWS["v_links"] in query:
            query = query.replace(VIEWS["v_links"], "SELECT * FROM {v_links}")
            inputs["v_links"] = self.links()
        used = [t for t in TABLES if "{" + t + "}" in query]
        return self.spark.sql(query, **inputs, **{t: self.table(t) for t in used})

    def view(self, name: str) -> DataFrame:
        """A view, with the position columns named as the library names them."""
        df = self.sql(f"SELECT * FROM {name}")
        return df.withColumnsRenamed({"start_pos": "start", "end_pos": "end"})

    def genes(self) -> DataFrame:
        """Genes in both dictionary shapes at once."""
        df = self.view("v_genes")
        return df.selectExpr(
            "gene_id", "gene_name", "split(synonyms, ';') AS gene_synonyms", "gene_chrom",
            "gene_start", "gene_end", "gene_chrom AS chr", "tss", "biotype", "description",
        )
