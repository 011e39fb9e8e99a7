"""Interval overlap join.

Every interval belongs to a length level; bins of a level are as wide as its longest interval, so
an interval touches at most two of them. A pair meets in the bins of its wider level, and is kept
only in the first bin both touch, so no pair comes out twice and nothing has to be de-duplicated.

That is for a right side that is broadcast. Else rows of the left side are shuffled, and as few of
them as can be: see :func:`_cells`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regulink.operators import joins
from regulink.operators.joins import fits_broadcast, lookup_join
from regulink.session import freeze, sizes_of

# bin width of level k is 2 ** (BASE_BITS + k * STEP_BITS); the widest exceeds any chromosome
BASE_BITS = 10
STEP_BITS = 4
LEVELS = 6


def _level(start: Column, end: Column) -> Column:
    length = end - start
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        level = F.when(length <= F.lit(1 << (BASE_BITS + k * STEP_BITS)), F.lit(k)).otherwise(level)
    return level


def _bin(position: Column, level: Column) -> Column:
    return F.call_function("shiftright", position, F.lit(BASE_BITS) + level * F.lit(STEP_BITS))


def _binned(
    df: DataFrame, start: Column, end: Column, own: str, other: str, other_levels: Column
) -> DataFrame:
    """One row per level of the other side and bin touched at the wider of the two levels."""
    wider = F.greatest(F.col(own), F.col(other))
    first = _bin(start, wider)
    last = _bin(F.greatest(end - 1, start), wider)
    return (
        df.withColumn(own, _level(start, end))
        .withColumn(other, F.explode(other_levels))
        .withColumn(f"_first{own}", first)
        .withColumn("_bin", F.explode(F.sequence(first, last)))
    )


def _cell(position: Column, level: int, lifted: bool) -> Column:
    """A bin of a level as one number. The widest level, for lengths beyond 2 ** 26, has one bin."""
    shift = BASE_BITS + level * STEP_BITS
    at = F.lit(0).cast("long") if level == LEVELS - 1 else F.shiftright(position.cast("long"), shift)
    return at * F.lit(2 * LEVELS) + F.lit(2 * level + lifted)


def _is_lifted(left: int, right: int) -> bool:
    """Whether a left row of level ``left`` meets a right one of level ``right`` in bins of the latter."""
    return right >= left + 2 or (right == LEVELS - 1 and left < right)


def _cells(start: Column, end: Column, mine: Sequence[int], others: Sequence[int], is_left: bool) -> Column:
    """The cells a row lies in, such that each pair that overlaps has exactly one in common.

    A left row lies in the one bin it starts in, on its own level, and on each level of the right side
    that is two or more above. A right row lies in every bin where a left row that overlaps it can
    start: with one longest left row's length ahead of it. So left rows are hardly repeated, and the
    smaller right side is.
    """
    level = _level(start, end)
    last = F.greatest(end - 1, start)
    some = []
    for own in mine:
        lifted = sorted({r for r in others if _is_lifted(own, r)}) if is_left else [own]
        if is_left:
            here = [F.array(_cell(start, own, False), *[_cell(start, r, True) for r in lifted])]
        else:
            under = [k for k in others if not _is_lifted(k, own)]
            above = [k for k in others if _is_lifted(k, own)]
            reach = [(k, k, False) for k in under] + ([(own, max(above), True)] if above else [])
            here = [_cell_range(start, last, *at) for at in reach]
        cells = F.concat(*here) if here else F.array().cast("array<long>")
        some.append(F.when(level == own, cells))
    return F.coalesce(*some) if some else F.array().cast("array<long>")


def _cell_range(start: Column, last: Column, level: int, longest: int, lifted: bool) -> Column:
    """Cells of a level in which a left row, no longer than level ``longest`` allows, can start."""
    if level == LEVELS - 1:
        return F.array(_cell(start, level, lifted))
    ahead = F.lit((1 << (BASE_BITS + longest * STEP_BITS)) - 1)
    return F.sequence(_cell(start - ahead, level, lifted), _cell(last, level, lifted), F.lit(2 * LEVELS).cast("long"))


def _fits_binned(right: DataFrame, binned: DataFrame) -> bool:
    """Whether the binned side may be broadcast. A row has at most two bins a level, so the size of
    ``right`` bounds it; only where that bound is too large is it counted, in one pass."""
    rows, size = sizes_of(right)
    most = 2 * LEVELS
    if most * rows <= joins.BROADCAST_MAX_ROWS and most * (size + 64 * rows) <= joins.BROADCAST_MAX_BYTES:
        return True
    return fits_broadcast(binned)


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str] = ("chrom", "start", "end"),
    right_on: Sequence[str] = ("chrom", "start", "end"),
    prefix: str = "b_",
) -> DataFrame:
    """All pairs on one chromosome with ``left.start < right.end and right.start < left.end``.

    Half-open coordinates. Keeps the columns of both sides; those of ``right`` get ``prefix``.
    ``right`` is the smaller side: it is broadcast when measured small, and otherwise both sides
    are shuffled on (chromosome, levels, bin) with crowded bins split.
    """
    l_chrom, l_start, l_end = left_on
    r_chrom, r_start, r_end = (prefix + name for name in right_on)
    # read for its levels, its size and the join, so written once
    right = freeze(right.select([F.col(name).alias(prefix + name) for name in right.columns]), "right", measured=True)
    output = [*left.columns, *right.columns]

    # at most LEVELS numbers, found in one pass over two columns of the smaller side
    present = right.agg(
        F.collect_set(_level(F.col(r_start), F.col(r_end))).alias("levels")
    ).scalar()
    every = F.array(*[F.lit(k) for k in range(LEVELS)])

    b = _binned(right, F.col(r_start), F.col(r_end), "_lb", "_la", every)
    b = b.withColumn("_chrom", F.col(r_chrom))
    if not _fits_binned(right, b):
        return _shuffled(left, right, left_on, (r_chrom, r_start, r_end)).select(*output)

    a = _binned(left, F.col(l_start), F.col(l_end), "_la", "_lb", present).withColumn("_chrom", F.col(l_chrom))
    return (
        lookup_join(a, b, ["_chrom", "_la", "_lb", "_bin"], "inner", True)
        .where(
            (F.col(l_start) < F.col(r_end))
            & (F.col(r_start) < F.col(l_end))
            & (F.col("_bin") == F.greatest("_first_la", "_first_lb"))
        )
        .select(*output)
    )


def _shuffled(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> DataFrame:
    """The overlap join of two large tables."""
    l_chrom, l_start, l_end = left_on
    r_chrom, r_start, r_end = right_on
    # read for its levels, for the counts of its keys and for the join, so written once
    left = freeze(left, "left")

    def held(df: DataFrame, start: str, end: str) -> list[int]:
        # at most LEVELS numbers
        return sorted(df.agg(F.collect_set(_level(F.col(start), F.col(end)))).first()[0])

    lefts, rights = held(left, l_start, l_end), held(right, r_start, r_end)
    at_left = _cells(F.col(l_start), F.col(l_end), lefts, rights, True)
    at_right = _cells(F.col(r_start), F.col(r_end), rights, lefts, False)
    a = left.withColumn("_cell", F.explode(at_left)).withColumnRenamed(l_chrom, "_chrom")
    b = right.withColumn("_cell", F.explode(at_right)).withColumn("_chrom", F.col(r_chrom))
    return (
        lookup_join(a, b, ["_chrom", "_cell"], "inner", False)
        .where((F.col(l_start) < F.col(r_end)) & (F.col(r_start) < F.col(l_end)))
        .withColumnRenamed("_chrom", l_chrom)
    )
