"""Joins of a large table with a lookup table, safe against hot keys.

A lookup side is measured before it is broadcast. Beyond the bound the join is shuffled, with the
rows of each hot key spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from regulink.session import freeze, row_bytes, sizes_of

# the driver holds a broadcast table about three times while it builds it, at some 200 bytes a row
BROADCAST_MAX_ROWS = 250_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024
HOT_KEYS = 10_000
SALTS = 64
BUCKETS = 1 << 15  # a bucket of keys none of which is hot has about a third of what makes one hot


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a table may be broadcast, by its measured size.

    A table that was measured when it was frozen is not read; others are, in one distributed pass
    that returns one row.
    """
    rows, size = sizes_of(df) or df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return rows <= BROADCAST_MAX_ROWS and (size or 0) <= BROADCAST_MAX_BYTES


def salt_of(columns: Sequence[str], salts: int) -> Column:
    """A salt fixed by a row's content and the partition it is in.

    The partition number spreads exact copies of one row; neither part depends on the order rows
    arrive in, so a task that is run again gives each row the same salt.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(salts)).cast("int")


def _same_hash(df: DataFrame, other: DataFrame, on: Sequence[str]) -> bool:
    """Whether keys that are equal in a join have one hash on both sides."""
    kinds = [(df.schema[name].dataType, other.schema[name].dataType) for name in on]
    return all(a == b and isinstance(a, (IntegralType, StringType)) for a, b in kinds)


def salted(
    df: DataFrame,
    others: Sequence[DataFrame],
    on: Sequence[str],
    how: str = "left",
    hot_keys: int = HOT_KEYS,
    salts: int = SALTS,
) -> tuple[DataFrame, ...]:
    """The sides of joins on ``on``, with a ``_salt`` that spreads the rows of keys with many rows of ``df``.

    Keys are counted first, by a hash into ``BUCKETS`` buckets, so that a task sends at most one count
    for each. Fewer than ``hot_keys`` buckets can each hold more than one row in ``hot_keys``, so the
    list of those is small enough to broadcast whatever the data. The more rows a bucket has, the more
    salts its keys get, at least ``salts`` and so many that a salt has no more than that share of all
    rows; only its rows of ``other`` are repeated once per salt. All other keys are joined as usual.
    Keys that only become equal by a cast, or are not whole numbers or text, are counted themselves.

    The counts are part of the plan of the join, so a shuffle that ``df`` begins with may serve both.
    """
    on = list(on)
    # rows without a key match nothing, and are spread as well
    no_key = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in on])
    row = salt_of(df.columns, 1 << 30)
    by = ["_bucket"] if all(_same_hash(df, other, on) for other in others) else on
    if by != on:
        bucket = F.when(~no_key, F.pmod(F.xxhash64(*on), F.lit(BUCKETS)).cast("int"))
        df, *others = (side.withColumn("_bucket", bucket) for side in (df, *others))
    # the join drops rows without a key from its sides, and only like plans share a shuffle
    counts = (df if how == "left" else df.where(~no_key)).groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    share = counts.agg((F.sum("_rows") / F.lit(hot_keys)).alias("share")).scalar()
    number = F.greatest(F.lit(salts), F.ceil(F.col("_rows") / share)).cast("int")
    # all sides must split the same keys into the same salts
    is_hot = (F.col("_rows") > 1) & (F.col("_rows") > share)
    hot = F.broadcast(counts.where(is_hot).select(*by, number.alias("_salts")))
    every_salt = F.sequence(F.lit(0), F.col("_salts") - 1)
    left = (
        df.join(hot, by, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNotNull(), F.pmod(row, "_salts"))
            .when(no_key, F.pmod(row, F.lit(SALTS)))
            .otherwise(F.lit(0)),
        )
        .drop("_salts", "_bucket")
    )
    every = F.explode(F.when(F.col("_salts").isNotNull(), every_salt).otherwise(F.array(F.lit(0))))
    rights = [o.join(hot, by, "left").withColumn("_salt", every).drop("_salts", "_bucket") for o in others]
    return left, *rights


def skew_join(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_keys: int = HOT_KEYS,
    salts: int = SALTS,
    once: bool = False,
) -> DataFrame:
    """Shuffle join of two large tables in which few keys may hold most rows of ``df``: see :func:`salted`.

    With ``once`` ``df`` is computed once, written, and its keys are counted from the written columns: better
    where it is the result of a join or another costly plan.
    """
    on = list(on)
    df = freeze(df, "joined") if once else df
    left, right = salted(df, [other], on, how, hot_keys, salts)
    # without hot keys Spark knows only the compressed size of a written table, by which it would broadcast it
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def group_join(
    df: DataFrame,
    per_group: DataFrame,
    by: Sequence[str],
    rows: str = "_rows",
    hot_groups: int = HOT_KEYS,
) -> DataFrame:
    """Inner join of rows with a table of their groups, which says how many rows each group has.

    A table that was measured when it was frozen, and is small, is broadcast. Else fewer than
    ``hot_groups`` groups can each hold more than one row in ``hot_groups``: these are broadcast,
    whatever the data, and their rows are spread evenly over the tasks of the shuffle that serves all
    other groups.
    """
    by = list(by)
    values = [name for name in per_group.columns if name not in (*by, rows)]
    if sizes_of(per_group) and fits_broadcast(per_group):
        return df.join(F.broadcast(per_group), by).select(*df.columns, *values)
    share = per_group.agg((F.sum(rows) / F.lit(hot_groups)).alias("share")).scalar()
    is_hot = F.col(rows) > share
    hot = per_group.where(is_hot).select(*by, F.struct(*values).alias("_hot"))
    cold = per_group.where(~is_hot).select(
        *by, F.struct(*values).alias("_cold"), F.lit(0).alias("_salt")
    )
    marked = df.join(F.broadcast(hot), by, "left").withColumn(
        "_salt",
        F.when(F.col("_hot").isNotNull(), salt_of(df.columns, SALTS) + 1).otherwise(F.lit(0)),
    )
    found = F.coalesce("_hot", "_cold")
    return (
        marked.join(cold, [*by, "_salt"], "left")
        .where(found.isNotNull())
        .select(*df.columns, *[found[name].alias(name) for name in values])
    )


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small: bool | None = None,
    once: bool = False,
) -> DataFrame:
    """Join a large table with a lookup table.

    ``small`` is the outcome of an earlier :func:`fits_broadcast`. When it is not given and the lookup
    was not measured, it is written once and measured on the way, so it is not computed twice.
    ``once`` is for :func:`skew_join`; a broadcast reads ``df`` once anyway.
    """
    if small is None and sizes_of(lookup) is None:
        lookup = freeze(lookup, "lookup", measured=True)
    if fits_broadcast(lookup) if small is None else small:
        return df.join(F.broadcast(lookup), list(on), how)
    return skew_join(df, lookup, on, how, once=once)
