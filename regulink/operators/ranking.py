"""Positions in a sorted order, for groups of any size.

Rows are range-partitioned by (group, order), so a hot group is cut into many partitions, each
partition counts its own rows, and only the counts (one row per group and partition) are summed up
in order. The partition number is frozen with the rows before it is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regulink.operators.joins import lookup_join, salt_of
from regulink.session import freeze

_LOCAL_ROW = (1 << 33) - 1  # row number part of monotonically_increasing_id


def _div(a: Column, b: Column) -> Column:
    """Whole-number quotient of non-negative whole numbers."""
    return F.call_function("div", a, b)


def _offsets(cells: DataFrame, by: Sequence[str], size: str) -> DataFrame:
    """Rows of the group before each cell, and in all cells of the group."""
    earlier = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn(
        "_before", F.coalesce(F.sum(size).over(earlier), F.lit(0))
    ).withColumn("_total", F.sum(size).over(Window.partitionBy(*by)))


def number_rows(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_rank`` (from 0, in ``order`` within the group) and ``_total`` (rows of the group).

    Rows equal in ``by`` and ``order`` are numbered in an arbitrary but fixed way.
    """
    columns = df.columns
    spread = df.withColumn("_tie", salt_of(columns, 1 << 20))
    keys = [*by, *order, "_tie"]
    placed = freeze(
        spread.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_cell", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_ROW)))
        .drop("_tie"),
        "ordered",
    )
    cells = placed.groupBy(*by, "_cell").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_row").alias("_first")
    )
    offsets = freeze(_offsets(cells, by, "_size"), "offsets", measured=True)
    return lookup_join(placed, offsets, [*by, "_cell"], "inner").select(
        *columns,
        (F.col("_before") + F.col("_row") - F.col("_first")).alias("_rank"),
        F.col("_total"),
    )


def tie_of(columns: Sequence[str]) -> Column:
    """The last key of an order: a hash of the row's content, so it is the same in every pass."""
    return F.xxhash64(*columns)


def bin_borders(df: DataFrame, bins: int, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Where the equal-sized bins of each group end: ``by`` and ``_borders``, a sorted array.

    A border is the struct ``key`` (the columns ``keys``) of the last row of a bin that is not the
    last one. ``before`` and ``rows`` say how many rows of the group come before that key and have
    it, ``total`` how many the group has; ``cut`` marks a key whose rows lie on both sides.

    Only the keys are read: they are counted with partial counts, range-partitioned, and one number
    per group and partition is summed up in order. Partitions that hold no border are not sorted.
    """
    counted = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_count"))
    placed = freeze(
        counted.repartitionByRange(*by, *keys).withColumn("_cell", F.spark_partition_id()), "counted"
    )
    cells = placed.groupBy(*by, "_cell").agg(F.sum("_count").alias("_size"))
    last = F.transform(F.sequence(F.lit(1), F.lit(bins - 1)), lambda j: last_of_bin(j, F.col("_total"), bins))
    begin, end = F.col("_before"), F.col("_before") + F.col("_size")
    wanted = F.filter(F.array_distinct(last), lambda r: (r >= begin) & (r < end) & (r < F.col("_total") - 1))
    offsets = freeze(
        _offsets(cells, by, "_size")
        .withColumn("_wanted", wanted)
        .where(F.size("_wanted") > 0)
        .select(*by, "_cell", "_before", "_total", "_wanted"),
        "offsets",
        measured=True,
    )
    so_far = Window.partitionBy(*by, "_cell").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row_end = F.col("_end")
    hit = F.filter("_wanted", lambda r: (r < row_end) & (r >= row_end - F.col("_count")))
    return freeze(
        lookup_join(placed, offsets, [*by, "_cell"], "inner")
        .withColumn("_end", F.col("_before") + F.sum("_count").over(so_far))
        .withColumn("_hit", hit)
        .where(F.size("_hit") > 0)
        .groupBy(*by)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        F.struct(*keys).alias("key"),
                        (row_end - F.col("_count")).alias("before"),
                        F.col("_count").alias("rows"),
                        F.col("_total").alias("total"),
                        F.exists("_hit", lambda r: r + 1 < row_end).alias("cut"),
                    )
                )
            ).alias("_borders")
        ),
        "borders",
        measured=True,
    )


def last_of_bin(number: Column, total: Column, bins: int) -> Column:
    """Rank of the last row of a bin; the first ``total % bins`` bins hold one row more."""
    return number * _div(total, F.lit(bins)) + F.least(number, total % bins) - 1


def bin_of_rank(rank: Column, total: Column, bins: int) -> Column:
    """Number (from 1) of the bin that holds a rank (from 0)."""
    share, longer = _div(total, F.lit(bins)), total % bins
    in_longer = longer * (share + 1)
    return (
        F.when(rank < in_longer, _div(rank, share + 1) + 1)
        .otherwise(longer + _div(rank - in_longer, F.greatest(share, F.lit(1))) + 1)
        .cast("int")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[Fraction | float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolated quantiles per group: columns ``by``, ``quantiles`` (array), ``n``.

    Missing values and NaN are left out. Equal values are counted before anything is sorted, so a
    much-repeated value is one row; the sorted values are spread over tasks by range. Positions are
    computed in whole numbers, so a quantile that falls on a data value equals it to the last bit.
    """
    exact = [Fraction(str(p)) if isinstance(p, float) else Fraction(p) for p in probs]
    keys = list(by) or ["_all"]
    source = df if by else df.withColumn("_all", F.lit(1))
    counted = (
        source.where(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    placed = freeze(
        counted.repartitionByRange(*keys, "_value").withColumn("_cell", F.spark_partition_id()),
        "counted",
    )
    cells = placed.groupBy(*keys, "_cell").agg(F.sum("_count").alias("_size"))

    # the probabilities as one constant array; positions are whole numbers and a remainder
    table = F.array(
        *[F.struct(F.lit(p.numerator).alias("num"), F.lit(p.denominator).alias("den")) for p in exact]
    )
    last = F.col("_total") - 1
    lows = F.transform(table, lambda p: _div(p["num"] * last, p["den"]))
    wanted = F.array_union(lows, F.transform(lows, lambda low: low + 1))
    in_cell = (F.col("_before"), F.col("_before") + F.col("_size"))
    offsets = freeze(
        _offsets(cells, keys, "_size")
        .withColumn(
            "_wanted", F.filter(wanted, lambda r: (r >= in_cell[0]) & (r < in_cell[1]))
        )
        .where(F.size("_wanted") > 0)
        .select(*keys, "_cell", "_before", "_total", "_wanted"),
        "offsets",
        measured=True,
    )
    # only cells with a wanted rank are sorted, and cells are of even size
    so_far = (
        Window.partitionBy(*keys, "_cell")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    row_end = F.col("_end")
    found = (
        lookup_join(placed, offsets, [*keys, "_cell"], "inner")
        .withColumn("_end", F.col("_before") + F.sum("_count").over(so_far))
        .withColumn(
            "_rank",
            F.explode(
                F.filter("_wanted", lambda r: (r < row_end) & (r >= row_end - F.col("_count")))
            ),
        )
    )
    # at most two ranks per probability, so the collected map is bounded
    at = (
        found.groupBy(*keys)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"),
            F.first("_total").alias("_total"),
        )
    )

    def interpolate(p: Column) -> Column:
        low = _div(p["num"] * last, p["den"])
        below = F.try_element_at("_at", low)
        above = F.coalesce(F.try_element_at("_at", low + 1), below)
        return below + (above - below) * (F.pmod(p["num"] * last, p["den"]) / p["den"])

    result = at.select(
        *keys, F.transform(table, interpolate).alias("quantiles"), F.col("_total").alias("n")
    )
    return result if by else result.drop("_all")
