"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink import operators as O
from regulink import sources as S
from regulink.fixed_values import CONSEQUENCE_WEIGHTS_V1, ENHANCER_MAX_DISTANCE
from regulink.functions import gtf_attr
from workload.registry import query
from workload.views import Data

LOCUS = 'chrom, start_pos AS start, end_pos AS "end"'


@query("p1_split_locus", "SELECT concat('chr', chrom) AS chrom, start_pos AS start, end_pos AS \"end\", score, bio_feature FROM v_links")
def split_locus(d: Data) -> DataFrame:
    baits = d.view("v_baits").select("target", "bio_feature")
    return O.split_locus(baits, "target").drop("target")


@query("p2_split_dotted", "SELECT concat('chr', chrom) AS chrom, start_pos AS start, end_pos AS \"end\", bio_feature AS biofeature_string FROM v_links")
def split_dotted(d: Data) -> DataFrame:
    return O.split_dotted(d.view("v_gene_lists")).drop("gene_names", "interval")


@query("p3_strip_chr", "SELECT replace(concat('chr', chrom, 'chr'), 'chr', '') AS chrom, start_pos AS start FROM v_links")
def strip_chr(d: Data) -> DataFrame:
    doubled = d.view("v_links").select(F.concat(F.lit("chr"), "chrom", F.lit("chr")).alias("chrom"), "start")
    return O.without_chr(doubled)


@query("p4_parse_packed_assoc", f"SELECT concat('chr', chrom) AS chrom, start_pos AS start, end_pos AS \"end\", lower(gene_name) AS gene_symbol, score FROM v_links")
def parse_packed_assoc(d: Data) -> DataFrame:
    return O.parse_packed_assoc(d.view("v_packed")).drop("name")


@query("p5_square_score", f"SELECT {LOCUS}, round(score * score, 6) AS score FROM v_intervals")
def square_score(d: Data) -> DataFrame:
    squared = O.square_score(d.view("v_intervals"))
    return squared.select("chrom", "start", "end", F.round("score", 6).alias("score"))


@query("p6_to_one_based", 'SELECT chrom, start_pos + 1 AS start, end_pos AS "end" FROM v_intervals')
def to_one_based(d: Data) -> DataFrame:
    return O.to_one_based(d.view("v_intervals")).select("chrom", "start", "end")


@query(
    "p7_gtf_attr",
    """SELECT CAST(p_partkey AS BIGINT) * 10 + k AS line_no, gene_id,
       CASE WHEN p_partkey % 4 = 0 THEN lower(gene_name) ELSE gene_name END AS gene_name,
       CASE WHEN k > 0 THEN biotype END AS transcript_biotype
FROM v_genes, (SELECT unnest([0, 1, 2]) AS k) copies""",
)
def gtf_attributes(d: Data) -> DataFrame:
    gtf = S.parse_gtf(d.view("v_gtf_lines"))
    keys = ["gene_id", "gene_name", "transcript_biotype"]
    return gtf.select("line_no", *[gtf_attr("attributes", k).alias(k) for k in keys])


TSS_SQL = """SELECT gene_chrom AS chrom, site - 1 AS start, site AS "end", gene_id AS name, '.' AS score
FROM (SELECT *, CASE strand WHEN '+' THEN gene_start WHEN '-' THEN gene_end END AS site FROM v_genes) g
WHERE site IS NOT NULL"""


@query("p8_transcript_tss", TSS_SQL)
def transcript_tss(d: Data) -> DataFrame:
    return O.transcript_tss(S.parse_gtf(d.view("v_gtf_lines")))


@query("f7_coding_transcript_tss", TSS_SQL + " AND biotype = 'protein_coding'")
def coding_transcript_tss(d: Data) -> DataFrame:
    return O.transcript_tss(S.parse_gtf(d.view("v_gtf_lines")), protein_coding=True)


@query(
    "p8_strand_report",
    """SELECT 2 * count(*) FILTER (strand <> '.') AS stranded,
       2 * count(*) FILTER (strand = '.') AS unstranded FROM v_genes""",
)
def strand_report(d: Data) -> DataFrame:
    return O.strand_report(S.parse_gtf(d.view("v_gtf_lines")))


@query(
    "p9_vcf_to_bed",
    """WITH sites AS (
  SELECT CAST(l_suppkey % 5 + 1 AS VARCHAR) AS chrom, l_orderkey * 1000 + l_linenumber AS pos,
         unnest(CASE WHEN l_linenumber % 3 = 0 THEN ['C', 'G'] ELSE ['T'] END) AS alt FROM {lineitem})
SELECT chrom, pos - 1 AS start, pos AS "end", concat(chrom, '_', CAST(pos AS VARCHAR), '_A_', alt) AS name,
       '.' AS score FROM sites""",
)
def vcf_to_bed(d: Data) -> DataFrame:
    return S.vcf_to_bed(S.parse_vcf_sites(d.view("v_vcf_lines")))


@query(
    "p10_split_variant_id",
    """SELECT varid, split_part(varid, '_', 1) AS var_chrom, split_part(varid, '_', 2) AS var_pos,
       split_part(varid, '_', 3) AS var_ref, split_part(varid, '_', 4) AS var_alt FROM v_nearest""",
)
def split_variant_id(d: Data) -> DataFrame:
    return O.split_variant_id(d.view("v_nearest").select("varid"))


@query(
    "p10_parse_vep_nearest",
    """SELECT chrom AS vep_chrom, CAST(pos AS VARCHAR) AS vep_pos,
       CASE WHEN pos % 3 = 0 THEN 'G0' ELSE coalesce(gene_id, 'none') END AS vep_nearest FROM v_qtl""",
)
def parse_vep_nearest(d: Data) -> DataFrame:
    return O.parse_vep_nearest(d.view("v_annotated"))


@query(
    "p11_explode_genes",
    """SELECT concat('chr', chrom, '.', CAST(start_pos AS VARCHAR), '.', CAST(end_pos AS VARCHAR)) AS "interval",
       bio_feature AS biofeature_string, unnest([gene_name, other_name]) AS gene_name FROM v_links""",
)
def explode_genes(d: Data) -> DataFrame:
    return O.explode_genes(d.view("v_gene_lists"))


QTL_OUT = """type_id AS type, type_id AS source, study_id, {feature}, chrom, pos, ref AS other_allele,
 alt AS effect_allele, gene_id AS ensembl_id, beta, se, pval"""


@query("p12_standardise_qtl", f"SELECT {QTL_OUT.format(feature='bio_feature')} FROM v_qtl")
def standardise_qtl(d: Data) -> DataFrame:
    return O.standardise_qtl(d.view("v_qtl"))


@query(
    "p13_standardise_qtl_composite",
    "SELECT " + QTL_OUT.format(feature="concat_ws('-', study_id, bio_feature) AS feature") + " FROM v_qtl",
)
def standardise_qtl_composite(d: Data) -> DataFrame:
    return O.standardise_qtl(d.view("v_qtl"), composite=True)


LABELS_SQL = """SELECT 'eqtl_catalogue_v2' AS original_source, replace(study, 'GTEx', 'GTEx-eQTL') AS study,
 qtl_group AS biofeature_string, upper(qtl_group) AS biofeature_code,
 tissue_ontology_id AS biofeature_ontology_term,
 replace(replace(tissue_label || ' ' || condition_label, ' naive', ''), '_', ' ') AS label,
 tissue_label, condition_label FROM v_meta"""


@query("p14_make_biofeature_labels", LABELS_SQL)
def make_biofeature_labels(d: Data) -> DataFrame:
    return O.make_biofeature_labels(d.view("v_meta"))


COMPOSITES_SQL = """SELECT 'composite_source_feature_hack' AS original_source, study,
 study || '-' || biofeature_string AS biofeature_string, study || '-' || biofeature_code AS biofeature_code,
 label FROM v_other_labels WHERE study IS NOT NULL"""


@query("p15_make_composites", COMPOSITES_SQL)
def make_composites(d: Data) -> DataFrame:
    return O.make_composites(d.view("v_other_labels"))


SCORE_SQL = """CASE WHEN type_id IN ('pchic', 'fantom5', 'dhscor') THEN nullif(interval_score, 0)
 WHEN type_id = 'vep' THEN (CASE feature WHEN 'missense_variant' THEN 0.7 WHEN 'stop_gained' THEN 0.95
   WHEN 'intron_variant' THEN 0.65 END)
 ELSE 1.0 - qtl_pval END"""


@query(
    "p16_evidence_score",
    f"""SELECT variant_id, gene_name, type_id, source_id, feature, round({SCORE_SQL}, 9) AS score
FROM v_evidence""",
)
def evidence_score(d: Data) -> DataFrame:
    weights = O.weights_frame(d.spark, CONSEQUENCE_WEIGHTS_V1)
    return O.evidence_score(d.view("v_evidence"), weights).select(
        "variant_id", "gene_name", "type_id", "source_id", "feature", F.round("score", 9).alias("score")
    )


@query(
    "p17_wipe_consequence_feature",
    """SELECT variant_id, source_id, CASE WHEN type_id = 'vep' THEN 'not_a_feature' ELSE feature END AS feature
FROM v_evidence""",
)
def wipe_consequence_feature(d: Data) -> DataFrame:
    return O.wipe_consequence_feature(d.view("v_evidence")).select("variant_id", "source_id", "feature")


WITH_DISTANCE = """WITH placed AS (
  SELECT i.*, g.gene_chrom, g.tss, abs((i.start_pos + i.end_pos) / 2 - g.tss) AS distance
  FROM v_intervals i JOIN v_genes g ON i.gene_id = g.gene_id)"""


def _placed(d: Data) -> DataFrame:
    genes = d.genes().select("gene_id", "gene_chrom", "tss")
    return O.add_distance(O.lookup_join(d.view("v_intervals"), genes, ["gene_id"], "inner"), "tss")


@query("p18_add_distance", f"{WITH_DISTANCE} SELECT {LOCUS}, gene_id, distance FROM placed")
def add_distance(d: Data) -> DataFrame:
    return _placed(d).select("chrom", "start", "end", "gene_id", "distance")


@query("p19_gene_midpoint", "SELECT gene_id, gene_chrom, (gene_start + gene_end) / 2 AS gene_mid FROM v_genes")
def gene_midpoint(d: Data) -> DataFrame:
    return O.gene_midpoint(d.genes())


@query("p20_constant_columns", f"SELECT {LOCUS}, 'unspecified' AS bio_feature, 1.0::DOUBLE AS score FROM v_intervals")
def constant_columns(d: Data) -> DataFrame:
    tagged = O.with_score(O.with_biofeature(d.view("v_intervals"), "unspecified"))
    return tagged.select("chrom", "start", "end", "bio_feature", "score")


@query("p21_neg_log10_pval", "SELECT chrom, pos, gene_id, round(-log10(pval), 6) AS score FROM v_qtl")
def neg_log10_pval(d: Data) -> DataFrame:
    return O.neg_log10_pval(d.view("v_qtl")).select("chrom", "pos", "gene_id", F.round("score", 6).alias("score"))


SIGNIFICANT = "pval <= 0.05 / nullif(num_tests, 0)"


@query("f1_bonferroni", f"SELECT * FROM v_qtl WHERE {SIGNIFICANT}")
def bonferroni(d: Data) -> DataFrame:
    return O.bonferroni(d.view("v_qtl"))


@query("f2_require", "SELECT * FROM v_qtl WHERE gene_id IS NOT NULL")
def require(d: Data) -> DataFrame:
    return O.require(d.view("v_qtl"), "gene_id")


@query("f3_cis_only", f"{WITH_DISTANCE} SELECT {LOCUS}, gene_id FROM placed WHERE chrom = gene_chrom")
def cis_only(d: Data) -> DataFrame:
    return O.cis_only(_placed(d)).select("chrom", "start", "end", "gene_id")


@query("f4_within", f"{WITH_DISTANCE} SELECT {LOCUS}, gene_id, distance FROM placed WHERE distance < 400000")
def within(d: Data) -> DataFrame:
    return O.within(_placed(d), 400_000).select("chrom", "start", "end", "gene_id", "distance")


@query(
    "f5_within_sd",
    f"""{WITH_DISTANCE}, cis AS (SELECT * FROM placed WHERE chrom = gene_chrom)
SELECT {LOCUS}, gene_id, distance FROM cis
WHERE distance <= 1.5 * (SELECT stddev_samp(distance) FROM cis)""",
)
def within_sd(d: Data) -> DataFrame:
    kept = O.within_sd(O.cis_only(_placed(d)), 1.5)
    return kept.select("chrom", "start", "end", "gene_id", "distance")


@query(
    "a4_distance_stddev",
    f"{WITH_DISTANCE} SELECT chrom, round(stddev_samp(distance), 4) AS sd FROM placed WHERE chrom = gene_chrom GROUP BY chrom",
)
def distance_stddev(d: Data) -> DataFrame:
    return O.cis_only(_placed(d)).groupBy("chrom").agg(F.round(F.stddev_samp("distance"), 4).alias("sd"))


@query("f6_gtf_features", "SELECT CAST(p_partkey AS BIGINT) * 10 AS line_no, gene_chrom AS seqname, strand FROM v_genes")
def gtf_features(d: Data) -> DataFrame:
    return O.gtf_features(S.parse_gtf(d.view("v_gtf_lines")), "gene").select("line_no", "seqname", "strand")


@query("f7_coding_genes", "SELECT gene_id, gene_name, biotype FROM v_genes WHERE biotype = 'protein_coding'")
def coding_genes(d: Data) -> DataFrame:
    return O.coding_genes(d.genes()).select("gene_id", "gene_name", "biotype")


@query("f8_filter_quant", "SELECT * FROM v_meta WHERE quant_method IN ('ge', 'microarray')")
def filter_quant(d: Data) -> DataFrame:
    return O.filter_quant(d.view("v_meta"))


@query(
    "f9_for_variant",
    "SELECT * FROM v_evidence WHERE variant_id IN ('1_7_A_C', '3_42_A_C') AND source_id IN ('vep', 'gtex_v7')",
)
def for_variant(d: Data) -> DataFrame:
    return O.for_variant(d.view("v_evidence"), "1_7_A_C", "3_42_A_C", sources=["vep", "gtex_v7"])


@query(
    "f10_allowed_chroms",
    """SELECT chain_id, replace(tgt_chrom, 'chr', '') AS tgt_chrom, tgt_start FROM v_blocks
WHERE tgt_chrom <> 'chrUn'""",
)
def allowed_chroms(d: Data) -> DataFrame:
    blocks = S.parse_chain(d.view("v_chain_lines"))
    return O.allowed_chroms(blocks, "tgt_chrom").select("chain_id", "tgt_chrom", "tgt_start")


@query(
    "f12_classify_cis_trans",
    """WITH c AS (
  SELECT q.*, CASE WHEN q.chrom = g.gene_chrom AND abs(q.pos - g.tss) <= 1000000 THEN 'cis_reg'
         ELSE 'trans_reg' END AS regulation
  FROM v_cis_qtl q JOIN v_genes g ON q.gene_id = g.gene_id)
SELECT * FROM c WHERE pval < CASE regulation WHEN 'cis_reg' THEN 2.5e-5 ELSE 5e-8 END""",
)
def classify_cis_trans(d: Data) -> DataFrame:
    return O.classify_cis_trans(d.view("v_cis_qtl"), d.genes())


@query(
    "a11_filter_report",
    f"""{WITH_DISTANCE} SELECT count(*) AS total, count(*) FILTER (chrom = gene_chrom) AS cis,
 round(count(*) FILTER (chrom = gene_chrom) * 100.0 / count(*), 6)::DOUBLE AS cis_percent,
 count(*) FILTER (distance < {ENHANCER_MAX_DISTANCE}) AS near,
 round(count(*) FILTER (distance < {ENHANCER_MAX_DISTANCE}) * 100.0 / count(*), 6)::DOUBLE AS near_percent
FROM placed""",
)
def filter_report(d: Data) -> DataFrame:
    report = O.filter_report(_placed(d), ENHANCER_MAX_DISTANCE)
    return report.withColumns({c: F.round(c, 6) for c in ("cis_percent", "near_percent")})
