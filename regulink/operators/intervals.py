"""Shaping, filtering and de-duplicating interval links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regulink.fixed_values import GENE_LIST_SD_MULTIPLE
from regulink.functions import (
    clean_score,
    in_chromosomes,
    midpoint_distance,
    strip_chr,
)

LINK_KEY = ("chrom", "start", "end", "gene_id")


def _fields(df: DataFrame, col: str, pattern: str, take: dict[str, tuple[int, str]]) -> DataFrame:
    """Fields of a split text as columns.

    They come out of a generator of one row, which later filters are not pushed through, so the
    text is split once however often the fields are used.
    """
    fields = [
        F.get("_fields", F.lit(i)).try_cast(kind).alias(name) for name, (i, kind) in take.items()
    ]
    kept = [name for name in df.columns if name not in take]
    return df.withColumn("_fields", F.split(col, pattern)).select(
        *kept, F.inline(F.array(F.struct(*fields)))
    )


_LOCUS = {"chrom": (0, "string"), "start": (1, "long"), "end": (2, "long")}


def split_locus(df: DataFrame, col: str, scored: bool = True) -> DataFrame:
    """``chr:start-end`` or ``chr:start-end,score`` into ``chrom, start, end[, score]``."""
    take = {**_LOCUS, "score": (3, "double")} if scored else _LOCUS
    return _fields(df, col, "[:,-]", take)


def split_dotted(df: DataFrame, col: str = "interval") -> DataFrame:
    """``chr.start.end`` into ``chrom, start, end``."""
    return _fields(df, col, r"\.", _LOCUS)


def without_chr(df: DataFrame, col: str = "chrom") -> DataFrame:
    return df.withColumn(col, strip_chr(col))


def parse_packed_assoc(df: DataFrame, col: str = "name") -> DataFrame:
    """``locus;_;symbol;R:score;…`` into ``chrom, start, end, gene_symbol, score``."""
    packed = _fields(
        df,
        col,
        ";",
        {"_locus": (0, "string"), "gene_symbol": (2, "string"), "score": (3, "string")},
    )
    number = F.replace("score", F.lit("R:"), F.lit("")).try_cast("double")
    return split_locus(packed, "_locus", scored=False).withColumn("score", number).drop("_locus")


def square_score(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.col("score") * F.col("score"))


def to_one_based(df: DataFrame) -> DataFrame:
    """Half-open from 0 to inclusive from 1."""
    return df.withColumn("start", F.col("start") + 1)


def explode_genes(df: DataFrame, col: str = "gene_names") -> DataFrame:
    """One row per gene of a ``;`` list; repeated genes stay repeated."""
    return df.withColumn("gene_name", F.explode(F.split(col, ";"))).drop(col)


def with_biofeature(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("bio_feature", F.lit(name))


def with_score(df: DataFrame, score: float = 1.0) -> DataFrame:
    return df.withColumn("score", F.lit(float(score)))


def add_distance(df: DataFrame, anchor: Column | str) -> DataFrame:
    """Distance from the middle of the interval to ``anchor``."""
    return df.withColumn("distance", midpoint_distance("start", "end", anchor))


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is missing."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def cis_only(df: DataFrame, a: str = "chrom", b: str = "gene_chrom") -> DataFrame:
    return df.where(F.col(a) == F.col(b))


def within(df: DataFrame, limit: float, col: str = "distance") -> DataFrame:
    """Distance strictly below a limit."""
    return df.where(F.col(col) < F.lit(limit))


def within_sd(df: DataFrame, k: float = GENE_LIST_SD_MULTIPLE, col: str = "distance") -> DataFrame:
    """Distance at most ``k`` sample standard deviations of all rows given.

    The deviation is a scalar subquery of the same plan. One row has none, so nothing is kept.
    """
    deviation = df.agg(F.stddev_samp(col)).scalar()
    return df.where(F.col(col) <= F.lit(k) * deviation)


def allowed_chroms(
    df: DataFrame, col: str = "chrom", allowed: Sequence[str] | None = None
) -> DataFrame:
    """Strip ``chr`` and keep the allowed chromosomes."""
    return df.where(in_chromosomes(col, None if allowed is None else list(allowed))).withColumn(
        col, strip_chr(col)
    )


def keep_best(df: DataFrame, keys: Sequence[str] = LINK_KEY, score: str = "score") -> DataFrame:
    """The highest score of each (interval, gene); other columns are dropped.

    A missing score counts only when all scores of the key are missing.
    """
    return df.groupBy(*keys).agg(F.max(clean_score(score)).alias(score))


def filter_report(
    df: DataFrame,
    limit: float,
    chrom: str = "chrom",
    gene_chrom: str = "gene_chrom",
    distance: str = "distance",
) -> DataFrame:
    """Rows in total, on the gene's chromosome, and within the limit; counts and percentages."""

    def count_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0))

    return df.agg(
        F.count(F.lit(1)).alias("total"),
        count_if(F.col(chrom) == F.col(gene_chrom)).alias("cis"),
        count_if(F.col(distance) < F.lit(limit)).alias("near"),
    ).select(
        "total",
        "cis",
        F.try_divide(F.col("cis") * 100.0, F.col("total")).alias("cis_percent"),
        "near",
        F.try_divide(F.col("near") * 100.0, F.col("total")).alias("near_percent"),
    )


def link_columns(df: DataFrame) -> DataFrame:
    """The six columns of an interval link, in order."""
    return df.select("chrom", "start", "end", "gene_id", F.col("score").cast("double"), "bio_feature")
