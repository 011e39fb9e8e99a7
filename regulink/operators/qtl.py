"""Molecular-QTL associations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink.fixed_values import CIS_PVAL, CIS_WINDOW, FAMILY_WISE_ALPHA, TRANS_PVAL
from regulink.functions import neg_log10
from regulink.operators.joins import lookup_join
from regulink.schemas import QTL_COLUMNS, QTL_COMPOSITE_COLUMNS


def bonferroni(df: DataFrame, alpha: float = FAMILY_WISE_ALPHA) -> DataFrame:
    """Keep p-values up to ``alpha / num_tests``; no tests or a missing value drops the row."""
    return df.where(F.col("pval") <= F.try_divide(F.lit(alpha), F.col("num_tests")))


def standardise_qtl(df: DataFrame, composite: bool = False) -> DataFrame:
    """Output names and column order.

    ``composite`` replaces ``bio_feature`` by ``feature``, the study and biofeature joined by a
    dash with missing parts left out.
    """
    renamed = df.select(
        F.col("type_id").alias("type"),
        F.col("type_id").alias("source"),
        "study_id",
        "bio_feature",
        F.concat_ws("-", "study_id", "bio_feature").alias("feature"),
        "chrom",
        "pos",
        F.col("ref").alias("other_allele"),
        F.col("alt").alias("effect_allele"),
        F.col("gene_id").alias("ensembl_id"),
        "beta",
        "se",
        "pval",
    )
    return renamed.select(QTL_COMPOSITE_COLUMNS if composite else QTL_COLUMNS)


def feature_list(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of the columns that name a data set."""
    return df.select(*columns).distinct()


def neg_log10_pval(df: DataFrame) -> DataFrame:
    """Add ``score``, ``-log10(pval)``."""
    return df.withColumn("score", neg_log10("pval"))


def classify_cis_trans(
    df: DataFrame,
    genes: DataFrame,
    window: int = CIS_WINDOW,
    cis_pval: float = CIS_PVAL,
    trans_pval: float = TRANS_PVAL,
    gene_chrom: str = "chr",
    gene_tss: str = "tss",
) -> DataFrame:
    """Add ``regulation`` (``cis_reg`` or ``trans_reg``) and keep what passes its p-value bound.

    An association is cis when it lies on the gene's chromosome within ``window`` of its start
    site, and trans otherwise.
    """
    lookup = genes.select(
        F.col("gene_id"), F.col(gene_chrom).alias("_chr"), F.col(gene_tss).alias("_tss")
    )
    is_cis = (F.col("chrom") == F.col("_chr")) & (F.abs(F.col("pos") - F.col("_tss")) <= window)
    return (
        lookup_join(df.where(F.col("pval") < max(cis_pval, trans_pval)), lookup, ["gene_id"], "inner")
        .withColumn("regulation", F.when(is_cis, "cis_reg").otherwise("trans_reg"))
        .where(
            F.col("pval")
            < F.when(F.col("regulation") == "cis_reg", cis_pval).otherwise(trans_pval)
        )
        .drop("_chr", "_tss")
    )
