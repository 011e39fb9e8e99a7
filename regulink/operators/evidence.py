"""Evidence look-up: answers for variants and gene-by-feature matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink.fixed_values import INTERVAL_TYPES
from regulink.operators.joins import group_join
from regulink.operators.membership import with_keys
from regulink.operators.scoring import (
    GENE_KEYS,
    per_source_scores,
    rank_genes,
    variant_gene_scores,
)
from regulink.session import freeze

QTL_EVIDENCE_TYPES = ("eqtl", "pqtl", "sqtl")
_USED = [
    "variant_id", "source_id", "feature", "type_id", "gene_name", "gene_id",
    "score_scaled", "qtl_beta", "qtl_pval", "interval_score",
]


def for_variant(df: DataFrame, *ids: str, sources: Sequence[str] | None = None) -> DataFrame:
    """Rows of given variants, and of given sources when named."""
    kept = df.where(F.col("variant_id").isin(list(ids)))
    return kept if sources is None else kept.where(F.col("source_id").isin(list(sources)))


def for_variant_table(df: DataFrame, ids: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """Rows of the variants in a table with ``variant_id``, however many, and of given sources."""
    kept = df if sources is None else df.where(F.col("source_id").isin(list(sources)))
    return with_keys(kept, ids, ["variant_id"])


def tissue_evidence(df: DataFrame) -> DataFrame:
    """The evidence as flat rows: variant, source, tissue and gene with the values of its type.

    ``df`` is scaled evidence; each of its rows is one row here, whatever the size of its group.
    """
    kind = F.col("type_id")
    is_qtl = kind.isin(list(QTL_EVIDENCE_TYPES))
    return df.select(
        "variant_id",
        "source_id",
        F.col("feature").alias("tissue_id"),
        "gene_name",
        "gene_id",
        F.col("score_scaled").alias("quantile"),
        F.when(is_qtl, F.col("qtl_beta")).alias("beta"),
        F.when(is_qtl, F.col("qtl_pval")).alias("pval"),
        F.when(kind.isin(INTERVAL_TYPES), F.col("interval_score")).alias("interval_score"),
    )


def source_ranks(df: DataFrame) -> DataFrame:
    """Genes, with their id, ranked per (variant, source) by their best quantile."""
    keys = ["variant_id", "source_id"]
    return rank_genes(per_source_scores(df, ids=True), keys, "ft_max", carry=("gene_id",))


def variant_ranks(df: DataFrame, weights=None) -> DataFrame:
    """Genes, with their id, ranked per variant by the weighted mean over sources."""
    scores = variant_gene_scores(per_source_scores(df, ids=True), weights, "ft_max", ids=True)
    return rank_genes(scores, carry=("gene_id",))


def source_evidence(df: DataFrame) -> DataFrame:
    """Flat evidence with the rank and the score of its gene within (variant, source).

    Rows without a variant, source or gene have no rank and are left out.
    """
    ranked = source_ranks(df).select(*GENE_KEYS, F.col("ft_max").alias("score"), "rank")
    sizes = df.groupBy(*GENE_KEYS).agg(F.count(F.lit(1)).alias("_rows"))
    return group_join(tissue_evidence(df), freeze(ranked.join(sizes, list(GENE_KEYS)), "ranks", measured=True), GENE_KEYS)


def variant_evidence(
    df: DataFrame,
    ids: Sequence[str] | DataFrame | None = None,
    sources: Sequence[str] | None = None,
    with_evidence: bool = True,
    weights=None,
) -> DataFrame:
    """The answer for variants: ranked genes and, unless asked not to, the flat evidence for them.

    ``df`` is scaled evidence, so that quantiles are those of the whole data. Without evidence a row
    is a gene of a variant: ``gene_id, score, rank``. With it a row is one piece of evidence, with
    the gene's ``source_score, source_rank`` and ``score, rank``. The shape is one at every size.
    ``ids`` may be a table with ``variant_id``.
    """
    if isinstance(ids, DataFrame):
        df = for_variant_table(df, ids)
    elif ids is not None:
        df = for_variant(df, *ids)
    if sources is not None:
        df = df.where(F.col("source_id").isin(list(sources)))
    df = df.select(_USED)
    per_source = per_source_scores(df, ids=True)
    if not with_evidence:
        scores = variant_gene_scores(per_source, weights, "ft_max", ids=True)
        return rank_genes(scores, carry=("gene_id",)).withColumnRenamed("src_agg", "score")
    df = freeze(df, "evidence")  # read for ranks and for rows
    per_source = per_source_scores(df, ids=True, counts=True)  # its shuffle serves both ranks
    by_source = rank_genes(per_source, ["variant_id", "source_id"], "ft_max", carry=("_rows",)).select(
        *GENE_KEYS, F.col("ft_max").alias("source_score"), F.col("rank").alias("source_rank"), "_rows"
    )
    scores = variant_gene_scores(per_source, weights, "ft_max", ids=True)
    by_variant = rank_genes(scores, carry=("gene_id",)).select(
        "variant_id", "gene_name", F.col("src_agg").alias("score"), "rank"
    )
    # one row for each known gene of a variant and source
    ranked = freeze(by_source.join(by_variant, ["variant_id", "gene_name"]), "ranks", measured=True)
    return group_join(tissue_evidence(df), ranked, GENE_KEYS)


def nested_answers(df: DataFrame, ids: Sequence[str], sources: Sequence[str] | None = None, weights=None) -> DataFrame:
    """The answers for the variants asked for, each as one row with nested arrays.

    Arrays hold all evidence of a variant, so this is for a stated list of ids.
    """
    rows = variant_evidence(df, ids, sources, True, weights)
    tissue = rows.groupBy("variant_id", "source_id", "tissue_id").agg(
        F.sort_array(
            F.collect_list(F.struct("gene_name", "gene_id", "quantile", "beta", "pval", "interval_score"))
        ).alias("raw_evidence")
    )
    source = tissue.groupBy("variant_id", "source_id").agg(
        F.sort_array(F.collect_list(F.struct("tissue_id", "raw_evidence"))).alias("sa_evidence")
    )
    ranks = rows.groupBy("variant_id", "source_id").agg(
        F.sort_array(
            F.collect_set(F.struct(F.col("source_rank").alias("rank"), "gene_name", F.col("source_score").alias("score")))
        ).alias("sa_rank")
    )
    answers = source.join(ranks, ["variant_id", "source_id"]).groupBy("variant_id").agg(
        F.sort_array(F.collect_list(F.struct("source_id", "sa_rank", "sa_evidence"))).alias("va_evidence")
    )
    genes = variant_evidence(df, ids, sources, False, weights).groupBy("variant_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "gene_name", "gene_id", "score"))).alias("va_rank")
    )
    return genes.join(answers, "variant_id").select("variant_id", "va_rank", "va_evidence")


def evidence_matrix(
    df: DataFrame,
    variant: str,
    by: str,
    values: Sequence[str],
    value: str = "score_scaled",
) -> DataFrame:
    """For one variant: a row per gene, a column per feature or source, the mean in the cells."""
    return for_variant(df, variant).groupBy("gene_name").pivot(by, list(values)).agg(F.avg(value))
