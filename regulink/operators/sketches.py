"""Summaries of slices that can be stored and merged: moments, quantiles and distinct counts.

A slice becomes one row of fixed size, whatever it holds. Rows of slices that were summarised at
different times, or by different jobs, are merged into the summary of all of them without reading the
data again. Counts, means and extremes are exact; quantiles and distinct counts carry a stated error.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILE_K = 800  # of the quantile sketch: a rank error of 0.35 percent
DISTINCT_LG_K = 14  # of the distinct count: a relative standard error of 0.8 percent
_MOMENTS = ("rows", "count", "mean", "m2", "min", "max")


def rank_error(k: int = QUANTILE_K) -> float:
    """Error of a rank, as a share of the rows, that a sketch stays within with 99 percent chance."""
    return 2.296 / k**0.9723


def quantile_k(error: float) -> int:
    """The smallest sketch whose rank error is at most ``error``."""
    if not 0.00005 <= error < 1:
        raise ValueError("a rank error must lie between 0.00005 and 1")
    return max(8, math.ceil((2.296 / error) ** (1 / 0.9723)))


def distinct_error(lg_k: int = DISTINCT_LG_K) -> float:
    """Relative standard error of a merged distinct count."""
    return 1.04 / math.sqrt(1 << lg_k)


def quantiles_of(sketch: Column, probs: Sequence[float], present: Column) -> Column:
    """An array of quantiles, null where nothing was sketched."""
    asked = F.array(*[F.lit(float(p)) for p in probs])
    return F.when(present, F.kll_sketch_get_quantile_double(F.when(present, sketch), asked))


def summarise_slices(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    distinct: Sequence[str] = (),
    k: int = QUANTILE_K,
    lg_k: int = DISTINCT_LG_K,
) -> DataFrame:
    """One row for each slice (a value of ``by``): moments and a quantile sketch of ``value``, and a
    sketch of the different values of each column of ``distinct``.

    Missing values and NaN count in ``rows`` only. Everything comes from one pass over ``df``, with
    partial results before the shuffle.
    """
    number = F.col(value).cast("double")
    number = F.when(~F.isnan(number), number)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(number).alias("count"),
        F.avg(number).alias("mean"),
        (F.var_pop(number) * F.count(number)).alias("m2"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        F.kll_sketch_agg_double(number, k).alias("quantiles"),
        *[F.hll_sketch_agg(name, lg_k).alias(f"distinct_{name}") for name in distinct],
    )


def merge_slices(slices: DataFrame, by: Sequence[str] = (), k: int = QUANTILE_K) -> DataFrame:
    """Summaries of all slices with equal ``by``, in the same shape.

    Squared deviations are added up around the common mean, so nothing cancels out.
    """
    sketches = [name for name in slices.columns if name.startswith("distinct_")]
    keys = list(by) or ["_all"]
    given = slices if by else slices.withColumn("_all", F.lit(0))
    # a slice without values has a null mean, and no weight
    means = given.groupBy(*keys).agg(F.try_divide(F.sum(F.col("count") * F.col("mean")), F.sum("count")).alias("_mean"))
    apart = F.col("mean") - F.col("_mean")
    merged = (
        given.join(means, keys)
        .groupBy(*keys)
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("count").alias("count"),
            F.first("_mean").alias("mean"),
            F.sum(F.col("m2") + F.col("count") * apart * apart).alias("m2"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.kll_merge_agg_double("quantiles", k).alias("quantiles"),
            *[F.hll_union_agg(name, False).alias(name) for name in sketches],
        )
    )
    return merged if by else merged.drop("_all")


def describe_slices(slices: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Readable statistics of summaries: ``rows, count, mean, std, min``, a column for each quantile,
    ``max``, and an estimate for each distinct count."""
    found = [name for name in slices.columns if name.startswith("distinct_")]
    keys = [name for name in slices.columns if name not in (*_MOMENTS, "quantiles", *found)]
    points = quantiles_of(F.col("quantiles"), probs, F.col("count") > 0)
    several = F.col("count") > 1
    return slices.withColumn("_q", points).select(
        *keys,
        "rows",
        "count",
        "mean",
        F.when(several, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"),
        "min",
        *[F.get("_q", F.lit(i)).alias(f"p{round(p * 100)}") for i, p in enumerate(probs)],
        "max",
        *[F.hll_sketch_estimate(name).alias(name.removeprefix("distinct_")) for name in found],
    )
