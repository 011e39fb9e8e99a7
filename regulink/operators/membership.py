"""Rows whose key is in a table of keys, for tables of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regulink.operators.joins import fits_broadcast, skew_join
from regulink.session import freeze, sizes_of

KEY_BITS = 12  # bits of the filter for each key
BLOCK_BITS = 12  # logarithm of the bits in a block
PROBES = 5  # bits of a key, all in one block
MOST_BLOCKS = 1 << 17  # 64 MB; a filter of more keys is left out
_WORDS = 1 << (BLOCK_BITS - 6)


def _probes(on: Sequence[str]) -> list[Column]:
    """The bits of a key within its block."""
    hashed = F.xxhash64(F.lit("bits"), *on)
    return [
        F.shiftrightunsigned(hashed, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
        for i in range(PROBES)
    ]


def _block(on: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), *on), F.lit(blocks)).cast("int")


def key_filter(keys: DataFrame, on: Sequence[str], blocks: int) -> DataFrame:
    """A Bloom filter of the keys as a table ``_block, _words``: all bits of a key lie in one block, so
    that a row meets one row of the table."""
    bit = F.col("_bit")
    return (
        keys.select(_block(on, blocks).alias("_block"), F.explode(F.array(*_probes(on))).alias("_bit"))
        .groupBy("_block", F.shiftright(bit, 6).alias("_word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit % 64)).alias("_bits"))
        .groupBy("_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_at"))
        .select(
            "_block",
            F.transform(
                F.sequence(F.lit(0), F.lit(_WORDS - 1)),
                lambda w: F.coalesce(F.try_element_at("_at", w), F.lit(0).cast("long")),
            ).alias("_words"),
        )
    )


def may_be_in(df: DataFrame, keys: DataFrame, on: Sequence[str], count: int) -> DataFrame:
    """The rows that pass the filter of ``count`` keys: all whose key is there, and a few others."""
    blocks = max(1, -(-count * KEY_BITS // (1 << BLOCK_BITS)))
    if blocks > MOST_BLOCKS:
        return df
    columns = df.columns
    table = freeze(key_filter(keys, on, blocks), "key-filter")
    found = [F.getbit(F.get("_words", F.shiftright(p, 6)), p % 64) == 1 for p in _probes(on)]
    passed = found[0]
    for one in found[1:]:
        passed = passed & one
    near = df.withColumn("_block", _block(on, blocks))
    return near.join(F.broadcast(table), "_block").where(passed).select(*columns)


def with_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``df``, with all their columns, whose key is in ``keys``; each once.

    Keys are made distinct, written and measured. Their least and greatest value go into the scan of
    ``df`` as a condition on the first key column, so files and row groups outside are not read. A
    small table of keys is broadcast. Of a larger one a Bloom filter is, with a size bound of its own,
    so that only few rows that do not match take part in the shuffle; hot keys are spread there.
    Rows and keys with a null do not match.
    """
    on = list(on)
    asked = keys.select(*on)
    for name in on:
        asked = asked.where(F.col(name).isNotNull())
    asked = freeze(asked.distinct(), "keys", measured=True)
    low, high = asked.agg(F.min(on[0]), F.max(on[0])).first()
    if low is None:
        return df.where(F.lit(False))
    near = df.where((F.col(on[0]) >= F.lit(low)) & (F.col(on[0]) <= F.lit(high)))
    if fits_broadcast(asked):
        return near.join(F.broadcast(asked), on, "left_semi")
    return skew_join(may_be_in(near, asked, on, sizes_of(asked)[0]), asked, on, "left_semi").select(*df.columns)
