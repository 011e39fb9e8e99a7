"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regulink.functions import split_part
from regulink.operators.genes import coding_genes
from regulink.operators.ranking import exact_quantiles
from regulink.operators.sketches import quantile_k, quantiles_of
from regulink.session import freeze

SUMMARY_PROBS = (0.25, 0.5, 0.75)
THRESHOLD_PROBS = (0.68, 0.75, 0.9, 0.95)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; an aggregate with partial results."""
    others = [name for name in df.columns if name not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return first.select(
        [F.col(f"_first.{name}").alias(name) if name in others else F.col(name) for name in df.columns]
    )


def split_variant_id(df: DataFrame, col: str = "varid", prefix: str = "var_") -> DataFrame:
    """``chrom_pos_ref_alt`` into four text columns."""
    names = ["chrom", "pos", "ref", "alt"]
    return df.withColumns(
        {f"{prefix}{name}": split_part(col, "_", i) for i, name in enumerate(names)}
    )


def parse_vep_nearest(df: DataFrame, loc: str = "loc", info: str = "info") -> DataFrame:
    """Position and nearest gene (the text after the last ``NEAREST=``) of annotator rows."""
    return df.withColumns(
        {
            "vep_chrom": split_part(loc, ":", 0),
            "vep_pos": split_part(loc, ":", 1),
            "vep_nearest": F.substring_index(info, "NEAREST=", -1),
        }
    ).drop(loc, info)


def nearest_concordance(
    variants: DataFrame,
    annotated: DataFrame,
    gene: str = "ensemblid_protein_coding",
    variant_order: Sequence[str] = ("varid",),
    annotated_order: Sequence[str] = ("vep_nearest",),
) -> DataFrame:
    """Nearest genes of variants next to the annotator's, one row per variant, with a mismatch flag.

    Both sides are reduced to the first row of their key before they meet.
    """
    ours = first_per_key(split_variant_id(variants), ["varid"], variant_order)
    theirs = first_per_key(annotated, ["vep_chrom", "vep_pos"], annotated_order)
    on = (F.col("var_chrom") == F.col("vep_chrom")) & (F.col("var_pos") == F.col("vep_pos"))
    mismatch = ~F.col(gene).eqNullSafe(F.col("vep_nearest"))
    return ours.join(theirs, on, "inner").withColumn("mismatch", mismatch)


def concordance_summary(compared: DataFrame) -> DataFrame:
    """Variants compared, and how many do not match."""
    return compared.agg(
        F.count(F.lit(1)).alias("variants"),
        F.coalesce(F.sum(F.col("mismatch").cast("int")), F.lit(0)).alias("mismatches"),
    )


def gene_coverage(genes: DataFrame, **lists: DataFrame) -> DataFrame:
    """Protein-coding genes with a flag per list for whether the gene is in it.

    A list may be any table with ``gene_id``; it is reduced to distinct ids first.
    """
    covered = coding_genes(genes).select("biotype", "gene_id", "gene_name", "description")
    for name, table in lists.items():
        members = table.select("gene_id").distinct().withColumn(name, F.lit(True))
        covered = covered.join(members, "gene_id", "left").withColumn(
            name, F.coalesce(name, F.lit(False))
        )
    return covered.select("biotype", "gene_id", "gene_name", "description", *lists)


def coverage_summary(covered: DataFrame, *names: str) -> DataFrame:
    """Genes in total and in each list."""
    return covered.agg(
        F.count(F.lit(1)).alias("genes"),
        *[F.coalesce(F.sum(F.col(n).cast("int")), F.lit(0)).alias(n) for n in names],
    )


def null_report(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in total, and rows in which each column is missing."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in columns],
    )


def assert_no_nulls(df: DataFrame, col: str) -> DataFrame:
    """The same rows; the job fails on reaching one in which ``col`` is missing."""
    checked = F.when(F.col(col).isNull(), F.raise_error(F.lit(f"missing value in {col}"))).otherwise(
        F.col(col)
    )
    return df.withColumn(col, checked)


def slice_stats(df: DataFrame, lg_k: int | None = None) -> DataFrame:
    """Rows, base pairs covered and distinct variants.

    With ``lg_k`` variants are counted by a sketch of ``2 ** lg_k`` cells instead, whose relative
    standard error is :func:`~regulink.operators.sketches.distinct_error`; the ids are then not
    shuffled. For statistics of many slices that are kept and added up see
    :func:`~regulink.operators.sketches.summarise_slices`.
    """
    if lg_k is None:
        variants = F.count_distinct("variant_id")
    else:
        variants = F.hll_sketch_estimate(F.hll_sketch_agg("variant_id", lg_k))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.max("position") - F.min("position")).alias("size_bp"),
        variants.alias("variants"),
    )


def describe_distance(
    df: DataFrame, col: str = "delta", probs: Sequence[float] = THRESHOLD_PROBS, error: float | None = None
) -> DataFrame:
    """Count, mean, standard deviation, extremes, quartiles and further quantiles, in one row.

    Quantiles are exact, for which the values are written once and sorted. With ``error``
    they come from a sketch in the one pass that counts: the rank of each is off by at most that
    share of the rows, with a chance of 99 percent.
    """
    points = sorted({*SUMMARY_PROBS, *probs})
    if error is not None:
        return _sketched_distance(df, col, points, error)
    df = freeze(df.select(col), "distances")  # read for the moments and for the quantiles
    values = exact_quantiles(df, col, [Fraction(str(p)) for p in points])
    return (
        df.agg(
            F.count(col).alias("count"),
            F.avg(col).alias("mean"),
            F.stddev_samp(col).alias("std"),
            F.min(col).alias("min"),
            F.max(col).alias("max"),
        )
        .withColumn("_q", values.select("quantiles").scalar())
        .select(
            "count",
            "mean",
            "std",
            "min",
            *[F.get("_q", F.lit(i)).alias(f"p{round(p * 100)}") for i, p in enumerate(points)],
            "max",
        )
    )


def _sketched_distance(df: DataFrame, col: str, points: Sequence[float], error: float) -> DataFrame:
    value = F.col(col).cast("double")
    sketch = F.kll_sketch_agg_double(F.when(~F.isnan(value), value), quantile_k(error))
    return (
        df.agg(
            F.count(col).alias("count"),
            F.avg(col).alias("mean"),
            F.stddev_samp(col).alias("std"),
            F.min(col).alias("min"),
            F.max(col).alias("max"),
            F.count_if(~F.isnan(value)).alias("_n"),
            sketch.alias("_sketch"),
        )
        .withColumn("_q", quantiles_of(F.col("_sketch"), points, F.col("_n") > 0))
        .select(
            "count",
            "mean",
            "std",
            "min",
            *[F.get("_q", F.lit(i)).alias(f"p{round(p * 100)}") for i, p in enumerate(points)],
            "max",
        )
    )


def distance_histogram(df: DataFrame, bins: int = 1000, col: str = "delta") -> DataFrame:
    """Counts in equal-width bins between the extremes, empty bins included; the last is closed."""
    df = freeze(df.select(col).where(F.col(col).isNotNull()), "distances")  # read for the span and for the counts
    value = F.col(col).cast("double")
    # one value only: a bin range of width 1 around it
    half = F.when(F.min(value) == F.max(value), F.lit(0.5)).otherwise(F.lit(0.0))
    span = df.agg((F.min(value) - half).alias("low"), (F.max(value) + half).alias("high"))
    span = freeze(span, "span")  # one row, read for both ends and for the list of bins
    low, high = span.select("low").scalar(), span.select("high").scalar()

    def edge(i: Column) -> Column:
        return F.col("_low") + i * (F.col("_high") - F.col("_low")) / F.lit(float(bins))

    number = F.least(F.floor(F.lit(bins) * (value - F.col("_low")) / (F.col("_high") - F.col("_low"))),
                     F.lit(bins - 1))
    counts = (
        df.withColumns({"_low": low, "_high": high})
        .groupBy(number.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return (
        span.select(
            F.col("low").alias("_low"),
            F.col("high").alias("_high"),
            F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        )
        .where(F.col("_low").isNotNull())
        .join(counts, "bin", "left")
        .select(
            "bin",
            edge(F.col("bin")).alias("low"),
            edge(F.col("bin") + 1).alias("high"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )
