"""Joins: symbols, synonyms, positions, overlap, coordinate conversion, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink import operators as O
from regulink import sources as S
from regulink.fixed_values import CONSEQUENCE_WEIGHTS_V1
from workload.columns import LABELS_SQL
from workload.registry import query
from workload.views import Data


@query(
    "j1_map_symbols",
    """SELECT l.chrom, l.start_pos AS start, l.end_pos AS "end", l.score, upper(l.gene_name) AS gene_symbol,
       g.gene_id, g.gene_chrom AS chr, g.tss
FROM v_links l JOIN v_genes g ON upper(l.gene_name) = g.gene_name""",
)
def map_symbols(d: Data) -> DataFrame:
    links = d.view("v_links").select(
        "chrom", "start", "end", "score", F.lower("gene_name").alias("gene_symbol")
    )
    return O.map_symbols(links, d.genes().select("gene_name", "gene_id", "chr", "tss"))


LAST_SYMBOL = """last_line AS (
  SELECT upper(gene_name) AS gene_symbol, arg_max(gene_id, p_partkey) AS gene_id FROM v_genes
  GROUP BY upper(gene_name))"""


@query("j2_symbol_map_from_gtf", f"WITH {LAST_SYMBOL} SELECT * FROM last_line")
def symbol_map_from_gtf(d: Data) -> DataFrame:
    return O.symbol_map_from_gtf(S.parse_gtf(d.view("v_gtf_lines")))


@query(
    "j2_map_symbols_from_gtf",
    f"""WITH {LAST_SYMBOL} SELECT l.chrom, l.start_pos AS start, l.end_pos AS "end", l.score, m.gene_id
FROM v_links l JOIN last_line m ON l.gene_name = m.gene_symbol""",
)
def map_symbols_from_gtf(d: Data) -> DataFrame:
    links = d.view("v_links").select("chrom", "start", "end", "score", F.lower("gene_name").alias("gene_symbol"))
    return O.map_symbols_from_gtf(links, S.parse_gtf(d.view("v_gtf_lines")))


SYNONYMS = """synonyms AS (
  SELECT s.gene_name, s.gene_id FROM
    (SELECT unnest(string_split(synonyms, ';')) AS gene_name, gene_id FROM v_genes) s
  WHERE s.gene_name NOT IN (SELECT gene_name FROM v_genes)),
names AS (SELECT gene_name, gene_id FROM v_genes UNION ALL SELECT * FROM synonyms)"""


@query("j3_gene_name_map", f"WITH {SYNONYMS} SELECT * FROM names")
def gene_name_map(d: Data) -> DataFrame:
    return O.gene_name_map(d.genes())


@query("u3_synonym_names", f"WITH {SYNONYMS} SELECT * FROM synonyms")
def synonym_names(d: Data) -> DataFrame:
    return O.synonym_names(d.genes())


@query(
    "u1_union_names",
    f"""WITH {SYNONYMS} SELECT gene_name, gene_id, 'official' AS kind FROM v_genes
UNION ALL SELECT gene_name, gene_id, 'synonym' FROM synonyms""",
)
def union_names(d: Data) -> DataFrame:
    genes = d.genes()
    official = O.official_names(genes).withColumn("kind", F.lit("official"))
    synonyms = O.synonym_names(genes).withColumn("kind", F.lit("synonym"))
    return official.unionByName(synonyms).select("gene_name", "gene_id", "kind")


@query(
    "j4_map_gene_names",
    f"""WITH {SYNONYMS}, listed AS (
  SELECT chrom, start_pos AS start, bio_feature,
         unnest([gene_name, other_name, concat('X', gene_name)]) AS gene_name FROM v_links)
SELECT listed.*, names.gene_id FROM listed LEFT JOIN names USING (gene_name)""",
)
def map_gene_names(d: Data) -> DataFrame:
    listed = d.view("v_links").select(
        "chrom", "start", "bio_feature",
        F.explode(F.array("gene_name", "other_name", F.concat(F.lit("X"), "gene_name"))).alias("gene_name"),
    )
    return O.map_gene_names(listed, O.gene_name_map(d.genes()))


@query(
    "j5_add_gene_position",
    """SELECT q.chrom, q.pos, q.gene_id, g.gene_chrom, (g.gene_start + g.gene_end) / 2 AS gene_mid
FROM v_qtl q LEFT JOIN v_genes g ON q.gene_id = g.gene_id""",
)
def add_gene_position(d: Data) -> DataFrame:
    return O.add_gene_position(d.view("v_qtl").select("chrom", "pos", "gene_id"), d.genes())


OVERLAP_SQL = """SELECT i.chrom, i.start_pos AS start, i.end_pos AS "end", i.gene_id, i.score, i.bio_feature,
       g.gene_id AS b_gene_id, {start} AS b_start, {end} AS b_end
FROM v_intervals i JOIN v_genes g ON i.chrom = g.gene_chrom AND i.start_pos < {end} AND {start} < i.end_pos"""


def _overlaps(d: Data, start: str, end: str) -> DataFrame:
    genes = d.genes().selectExpr("gene_id", "gene_chrom AS chrom", f"{start} AS start", f"{end} AS end")
    return O.overlap_join(d.view("v_intervals"), genes).drop("b_chrom")


@query("j6_overlap_join_points", OVERLAP_SQL.format(start="(g.tss - 1)", end="g.tss"))
def overlap_join_points(d: Data) -> DataFrame:
    return _overlaps(d, "tss - 1", "tss")


@query("j6_overlap_join_bodies", OVERLAP_SQL.format(start="g.gene_start", end="g.gene_end"))
def overlap_join_bodies(d: Data) -> DataFrame:
    return _overlaps(d, "gene_start", "gene_end")


def lift_sql(rows: str, columns: str, maxdiff: int = 100) -> str:
    """CTEs that lift ``rows`` (chrom, start_pos, end_pos and ``columns``) into ``lifted``."""
    return f"""spans AS MATERIALIZED (SELECT DISTINCT chrom, start_pos, end_pos FROM {rows}),
usable AS MATERIALIZED (SELECT chain_id, score AS chain_score, src_chrom, src_start, src_end,
                  replace(tgt_chrom, 'chr', '') AS tgt_chrom, tgt_size, tgt_strand, tgt_start
           FROM v_blocks WHERE tgt_chrom <> 'chrUn'),
starts AS MATERIALIZED (
  SELECT s.*, b.tgt_chrom AS new_chrom,
         CASE WHEN tgt_strand = '-' THEN tgt_size - 1 - (tgt_start + start_pos - 1 - src_start)
              ELSE tgt_start + start_pos - 1 - src_start END + 1 AS a,
         row_number() OVER (PARTITION BY s.chrom, start_pos, end_pos ORDER BY chain_score DESC, chain_id) AS rn
  FROM spans s JOIN usable b ON s.chrom = b.src_chrom AND src_start <= start_pos - 1 AND start_pos - 1 < src_end),
ends AS MATERIALIZED (
  SELECT s.chrom, s.start_pos, s.end_pos, s.new_chrom, s.a,
         CASE WHEN tgt_strand = '-' THEN tgt_size - 1 - (tgt_start + end_pos - 1 - src_start)
              ELSE tgt_start + end_pos - 1 - src_start END + 1 AS b,
         row_number() OVER (PARTITION BY s.chrom, start_pos, end_pos ORDER BY chain_score DESC, chain_id) AS rn
  FROM (SELECT * FROM starts WHERE rn = 1) s
  JOIN usable b ON s.chrom = b.src_chrom AND src_start <= end_pos - 1 AND end_pos - 1 < src_end
                AND b.tgt_chrom = s.new_chrom),
moved AS MATERIALIZED (
  SELECT chrom, start_pos, end_pos, new_chrom, least(a, b) AS new_start, greatest(a, b) AS new_end FROM ends
  WHERE rn = 1 AND abs(abs(start_pos - end_pos) - abs(a - b)) <= {maxdiff}),
lifted AS MATERIALIZED (
  SELECT m.new_chrom AS chrom, m.new_start AS start_pos, m.new_end AS end_pos, {columns}
  FROM {rows} r JOIN moved m USING (chrom, start_pos, end_pos))"""


LIFTED_OUT = 'SELECT chrom, start_pos AS start, end_pos AS "end", gene_id, score, bio_feature FROM lifted'
LIFTED = "WITH " + lift_sql("v_intervals", "gene_id, r.score, bio_feature") + LIFTED_OUT
LIFTED_FAR = "WITH " + lift_sql("v_intervals", "gene_id, r.score, bio_feature", 2000) + LIFTED_OUT


@query("j7_liftover", LIFTED)
def liftover(d: Data) -> DataFrame:
    return O.liftover(d.view("v_intervals"), S.parse_chain(d.view("v_chain_lines")))


@query("j7_liftover_large_chain", LIFTED)
def liftover_large_chain(d: Data) -> DataFrame:
    """The plan for a chain table that is too large to broadcast."""
    return O.liftover(d.view("v_intervals"), S.parse_chain(d.view("v_chain_lines")), small=False)


@query("f11_length_drift", LIFTED_FAR)
def length_drift(d: Data) -> DataFrame:
    return O.liftover(d.view("v_intervals"), S.parse_chain(d.view("v_chain_lines")), maxdiff=2000)


@query(
    "w5_best_target",
    """WITH usable AS (SELECT * FROM v_blocks WHERE tgt_chrom <> 'chrUn'), hits AS (
  SELECT DISTINCT i.chrom, i.start_pos, replace(b.tgt_chrom, 'chr', '') AS new_chrom, b.score, b.chain_id
  FROM v_intervals i JOIN usable b ON i.chrom = b.src_chrom AND src_start <= start_pos - 1
       AND start_pos - 1 < src_end),
best AS (SELECT *, row_number() OVER (PARTITION BY chrom, start_pos ORDER BY score DESC, chain_id) AS rn
         FROM hits)
SELECT chrom AS old_chrom, start_pos AS old_start, new_chrom FROM best WHERE rn = 1""",
)
def best_target(d: Data) -> DataFrame:
    """One base lifted: both ends are the same position, so only the choice of target counts."""
    points = d.view("v_intervals").select("chrom", "start").distinct()
    points = points.selectExpr("chrom", "start", "start AS end", "chrom AS old_chrom", "start AS old_start")
    lifted = O.liftover(points, S.parse_chain(d.view("v_chain_lines")))
    return lifted.select("old_chrom", "old_start", F.col("chrom").alias("new_chrom"))


MAPPED_SQL = """SELECT i.chrom, i.start_pos AS start, i.gene_id, m.biofeature_code AS bio_feature
FROM v_intervals i JOIN v_labels m ON i.bio_feature = m.biofeature_string"""


def _links(d: Data) -> DataFrame:
    return d.view("v_intervals").select("chrom", "start", "gene_id", "bio_feature")


@query("j8_map_biofeature", MAPPED_SQL)
def map_biofeature(d: Data) -> DataFrame:
    return O.map_biofeature(_links(d), d.view("v_labels"))


@query(
    "j9_lookup_biofeature",
    """SELECT i.chrom, i.start_pos AS start, i.gene_id, concat('LAST_', i.bio_feature) AS bio_feature
FROM v_intervals i""",
)
def lookup_biofeature(d: Data) -> DataFrame:
    first = d.view("v_labels").withColumn("line", F.lit(1))
    second = first.withColumns(
        {"line": F.lit(2), "biofeature_code": F.concat(F.lit("LAST_"), "biofeature_string")}
    )
    return O.lookup_biofeature(_links(d), first.unionByName(second), "line")


@query(
    "j8_missing_labels",
    """SELECT study_id AS bio_feature, count(*) AS rows FROM v_qtl
WHERE study_id NOT IN (SELECT biofeature_string FROM v_labels) GROUP BY study_id""",
)
def missing_labels(d: Data) -> DataFrame:
    return O.missing_labels(d.view("v_qtl").select(F.col("study_id").alias("bio_feature")), d.view("v_labels"))


@query(
    "j10_consequence_weights",
    """SELECT feature, CAST(CASE feature WHEN 'missense_variant' THEN 0.7 WHEN 'stop_gained' THEN 0.95
       ELSE 0.65 END AS DOUBLE) AS score, count(*) AS n
FROM v_evidence WHERE type_id = 'vep' GROUP BY feature""",
)
def consequence_weights(d: Data) -> DataFrame:
    rows = d.view("v_evidence").where("type_id = 'vep'")
    scored = O.evidence_score(rows, O.weights_frame(d.spark, CONSEQUENCE_WEIGHTS_V1))
    return scored.groupBy("feature", "score").agg(F.count(F.lit(1)).alias("n"))


CONCORDANCE = """WITH ours AS (SELECT varid, min(ensemblid_protein_coding) AS gene FROM v_nearest GROUP BY varid),
theirs AS (
  SELECT split_part(loc, ':', 1) AS c, split_part(loc, ':', 2) AS p,
         min(split_part(info, 'NEAREST=', 2)) AS nearest FROM v_annotated GROUP BY loc),
compared AS (
  SELECT varid, gene AS ensemblid_protein_coding, nearest AS vep_nearest, gene <> nearest AS mismatch
  FROM ours JOIN theirs ON split_part(varid, '_', 1) = c AND split_part(varid, '_', 2) = p)"""


def _compared(d: Data) -> DataFrame:
    return O.nearest_concordance(
        d.view("v_nearest"),
        O.parse_vep_nearest(d.view("v_annotated")),
        variant_order=["ensemblid_protein_coding"],
    )


@query("j11_nearest_concordance", f"{CONCORDANCE} SELECT * FROM compared")
def nearest_concordance(d: Data) -> DataFrame:
    return _compared(d).select("varid", "ensemblid_protein_coding", "vep_nearest", "mismatch")


@query(
    "j11_concordance_summary",
    f"{CONCORDANCE} SELECT count(*) AS variants, count(*) FILTER (mismatch) AS mismatches FROM compared",
)
def concordance_summary(d: Data) -> DataFrame:
    return O.concordance_summary(_compared(d))


COVERAGE = """WITH covered AS (
  SELECT biotype, gene_id, gene_name, description,
         gene_id IN (SELECT gene_id FROM v_qtl WHERE gene_id IS NOT NULL) AS qtl_gene,
         gene_id IN (SELECT gene_id FROM v_intervals) AS link_gene
  FROM v_genes WHERE biotype = 'protein_coding')"""


def _covered(d: Data) -> DataFrame:
    return O.gene_coverage(
        d.genes(),
        qtl_gene=d.view("v_qtl"),
        link_gene=d.view("v_intervals"),
    )


@query("j12_gene_coverage", f"{COVERAGE} SELECT * FROM covered")
def gene_coverage(d: Data) -> DataFrame:
    return _covered(d)


@query(
    "a13_coverage_summary",
    f"""{COVERAGE} SELECT count(*) AS genes, count(*) FILTER (qtl_gene) AS qtl_gene,
 count(*) FILTER (link_gene) AS link_gene FROM covered""",
)
def coverage_summary(d: Data) -> DataFrame:
    return O.coverage_summary(_covered(d), "qtl_gene", "link_gene")


@query(
    "j13_remap_biofeatures",
    """SELECT q.chrom, q.pos, coalesce(m.study_id, q.study_id) AS study_id,
       coalesce(m.biofeature_code, q.bio_feature) AS bio_feature
FROM v_qtl q LEFT JOIN v_remap m ON q.study_id = m.old_study_id AND q.bio_feature = m.old_bio_feature_code""",
)
def remap_biofeatures(d: Data) -> DataFrame:
    qtl = d.view("v_qtl").select("chrom", "pos", "study_id", "bio_feature")
    return O.remap_biofeatures(qtl, d.view("v_remap"))


DELTAS = """WITH deltas AS (
  SELECT i.*, abs((i.start_pos + i.end_pos) / 2 - g.tss) AS delta
  FROM v_intervals i JOIN v_genes g ON i.gene_id = g.gene_id AND i.chrom = g.gene_chrom)"""


@query(
    "j14_link_distances",
    f"""{DELTAS} SELECT chrom, start_pos AS start, end_pos AS "end", gene_id, score, bio_feature, delta
FROM deltas""",
)
def link_distances(d: Data) -> DataFrame:
    return O.link_distances(d.view("v_intervals"), d.genes())


@query(
    "u2_concat_labels",
    f"""SELECT original_source, study, biofeature_string, biofeature_code, label,
       NULL AS biofeature_ontology_term, NULL AS tissue_label, NULL AS condition_label FROM v_other_labels
UNION ALL SELECT original_source, study, biofeature_string, biofeature_code, label,
       biofeature_ontology_term, tissue_label, condition_label FROM ({LABELS_SQL}) x""",
)
def concat_labels(d: Data) -> DataFrame:
    return O.concat_labels(d.view("v_other_labels"), O.make_biofeature_labels(d.view("v_meta")))
