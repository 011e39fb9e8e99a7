"""Coordinate conversion between assemblies.

The blocks of all chains are cut into segments that lie in one bin and have the same best chain
throughout. A position then falls in at most one segment, which already knows its best target, so
converting a position is one equi-join on the bin with a range condition.

Which chain is best at each place of a bin is found by halves: a bin is a tree of halves, quarters
and so on, and a block is laid on the few nodes that make it up. Each node keeps its best block, a
minimum with partial results, and the best block at a place is the best on the path above it. Work
grows with the ends of blocks, not with how many overlap, and a bin never has more nodes than twice
its positions, however many chains cross it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regulink.fixed_values import MAX_LENGTH_DRIFT
from regulink.functions import in_chromosomes, strip_chr
from regulink.operators.joins import fits_broadcast, lookup_join, salted
from regulink.session import freeze

# a bin has 2 ** BIN_BITS positions, which also bounds the number of segments in it
BIN_BITS = 14
# a region has 2 ** REGION_BITS bins and knows the bin that follows it, so that most rows have both ends in one
REGION_BITS = 2
# a region that is hot has its targets repeated at least so often
REGION_SALTS = 8
ANY_CHROMOSOME = "*"


def _bin(position: Column) -> Column:
    return F.call_function("shiftright", position, F.lit(BIN_BITS))


def _region(bin_number: Column) -> Column:
    return F.call_function("shiftright", bin_number, F.lit(REGION_BITS))


def usable_blocks(blocks: DataFrame, allowed: list[str] | None = None) -> DataFrame:
    """Blocks whose target chromosome is an allowed one, with ``chr`` stripped from it."""
    return blocks.where(in_chromosomes("tgt_chrom", allowed)).withColumn(
        "tgt_chrom", strip_chr("tgt_chrom")
    )


def _pieces(blocks: DataFrame) -> DataFrame:
    """Blocks cut at bin ends: ``_from, _to`` within the bin, and where they lead."""
    on_minus = F.col("tgt_strand") == "-"
    aligned = F.col("tgt_start") - F.col("src_start")
    begin = F.shiftleft("_bin", BIN_BITS)
    return (
        blocks.where(F.col("src_start") < F.col("src_end"))
        .withColumn("_bin", F.explode(F.sequence(_bin(F.col("src_start")), _bin(F.col("src_end") - 1))))
        .select(
            strip_chr("src_chrom").alias("chrom"),
            "_bin",
            F.greatest(F.col("src_start") - begin, F.lit(0)).cast("int").alias("_from"),
            F.least(F.col("src_end") - begin, F.lit(1 << BIN_BITS)).cast("int").alias("_to"),
            F.struct(
                F.struct((-F.col("score")).alias("minus_score"), "chain_id").alias("preference"),
                F.col("tgt_chrom").alias("new_chrom"),
                F.when(on_minus, F.col("tgt_size") - 1 - aligned).otherwise(aligned).alias("offset"),
                F.when(on_minus, -1).otherwise(1).alias("sign"),
            ).alias("_target"),
        )
    )


def _nodes() -> Column:
    """Nodes of the tree over a bin that make up ``_from .. _to``: at most two on each level.

    On level ``k`` a node has ``2 ** k`` positions. Going up, an odd left end and an odd right end
    leave one node each behind, as long as the ends have not met.
    """

    def on_level(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1), level)
        left = F.call_function("div", F.col("_from") + size - 1, size).cast("int")
        right = F.call_function("div", F.col("_to"), size).cast("int")
        return F.array(
            F.when((left < right) & (left % 2 == 1), F.struct(level.alias("level"), left.alias("node"))),
            F.when((left < right) & (right % 2 == 1), F.struct(level.alias("level"), (right - 1).alias("node"))),
        )

    levels = F.array(*[F.lit(k) for k in range(BIN_BITS + 1)])
    some = F.filter(F.flatten(F.transform(levels, on_level)), lambda node: node.isNotNull())
    # most pieces of long blocks are a whole bin
    root = F.array(F.struct(F.lit(BIN_BITS).alias("level"), F.lit(0).alias("node")))
    return F.when((F.col("_from") == 0) & (F.col("_to") == 1 << BIN_BITS), root).otherwise(some)


def _best_segments(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, seg_start, seg_end`` and the best target, of every stretch of a bin that has one.

    Stretches that follow each other with one target are one segment.
    """
    best = F.min("_target").alias("_target")
    begins, ends = F.col("_from") == 0, F.col("_to") == 1 << BIN_BITS
    # most pieces are whole bins, which is one node and two places; a bin has at most 2 ** BIN_BITS others
    laid = pieces.groupBy(*keys, "_from", "_to").agg(best).withColumn("_nodes", _nodes())
    nodes = laid.select(*keys, F.inline("_nodes"), "_target").groupBy(*keys, "level", "node").agg(best)
    levels = F.aggregate("_nodes", F.lit(0), lambda held, n: held.bitwiseOR(F.call_function("shiftleft", F.lit(1), n["level"])))
    levels = F.when(begins & ends, 1 << BIN_BITS).otherwise(levels)
    bins = laid.groupBy(*keys).agg(
        F.collect_set(F.when(~begins, F.col("_from"))).alias("_a"),
        F.collect_set(F.when(~ends, F.col("_to"))).alias("_b"),
        F.bit_or(levels).alias("_levels"),
    )
    # places where the best target may change; a bin may begin without one
    starts = bins.select(
        *keys, "_levels", F.explode(F.array_union(F.array(F.lit(0)), F.array_union("_a", "_b"))).alias("_at")
    )
    # only levels that the bin has a node on
    path = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(BIN_BITS)),
            lambda level: F.struct(
                level.alias("level"), F.call_function("shiftright", F.col("_at"), level).alias("node")
            ),
        ),
        lambda step: F.call_function("shiftright", F.col("_levels"), step["level"]) % 2 == 1,
    )
    root = F.array(F.struct(F.lit(BIN_BITS).alias("level"), F.lit(0).alias("node")))
    path = F.when(F.col("_levels") == 1 << BIN_BITS, root).otherwise(path)
    # a size estimated from the chain text knows nothing of bins and nodes, so it must not lead to a broadcast
    found = (
        starts.select(*keys, "_at", F.inline(path))
        .join(nodes.hint("merge"), [*keys, "level", "node"], "left")
        .repartition(*keys)  # as the window needs them: a bin has a bounded number of places and levels
        .groupBy(*keys, "_at")
        .agg(best)
    )
    in_bin = Window.partitionBy(*keys).orderBy("_at")
    changed = ~F.col("_target").eqNullSafe(F.lag("_target").over(in_bin))
    begin = F.shiftleft("_bin", BIN_BITS)
    return (
        found.withColumn("_new", changed)
        .where("_new")
        .withColumn("_to", F.lead("_at").over(in_bin))
        .where(F.col("_target").isNotNull())
        .select(
            *keys,
            (begin + F.col("_at")).alias("seg_start"),
            (begin + F.coalesce("_to", F.lit(1 << BIN_BITS))).alias("seg_end"),
            "_target.*",
        )
    )


def lift_segments(blocks: DataFrame) -> DataFrame:
    """Segments with the best target on each target chromosome, named in ``within``, and with the best
    of all, where ``within`` is ``ANY_CHROMOSOME``.

    A source position ``p`` of a segment goes to ``offset + sign * p``; on the minus strand the
    target counts from its far end. ``preference`` sorts by chain score, highest first, and then
    by chain id.
    """
    pieces = _pieces(blocks)
    twice = F.explode(F.array(F.col("_target.new_chrom"), F.lit(ANY_CHROMOSOME)))
    return _best_segments(pieces.withColumn("within", twice), ["chrom", "_bin", "within"])


def placed_together(
    rows: DataFrame, over_all: DataFrame, by_chrom: DataFrame, placed: Callable[[DataFrame, str, str], DataFrame]
) -> DataFrame:
    """Both ends of rows that have them in their ``_region`` or in the bin after it, from one shuffle.

    The joins have the same keys, so that the second needs neither a shuffle nor a sort. For that the new
    chromosome is compared by order: an equality would become a key.
    """
    keys = ["chrom", "_region"]
    own = _region(F.col("_bin"))
    is_first = F.col("_bin") == F.call_function("shiftleft", own, F.lit(REGION_BITS))
    starts = over_all.withColumn("_region", own).drop("_bin")
    ends = (
        by_chrom.withColumn("_region", F.explode(F.when(is_first, F.array(own, own - 1)).otherwise(F.array(own))))
        .withColumnRenamed("new_chrom", "_end_chrom")
        .drop("_bin")
    )
    rows, starts, ends = salted(rows, [starts, ends], keys, "inner", salts=REGION_SALTS)
    keys.append("_salt")
    with_start = placed(rows.join(starts.hint("merge"), keys), "start", "_a")
    same = F.col("new_chrom").between(F.col("_end_chrom"), F.col("_end_chrom"))
    return placed(with_start.join(ends.hint("merge"), keys).where(same), "end", "_b").drop("_end_chrom", *keys[1:])


def liftover(
    df: DataFrame,
    blocks: DataFrame,
    maxdiff: int = MAX_LENGTH_DRIFT,
    allowed: list[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Convert ``chrom, start, end`` (1-based, inclusive); other columns stay as they are.

    Each end goes to the target of the best chain over it. A row is dropped when an end has no
    target, when no end target lies on the start's new chromosome, or when the length changes by
    more than ``maxdiff``. Ends that come out reversed are swapped. ``small`` says whether the
    segments may be broadcast; they are measured when it is not given.

    If not, rows with both ends in one region are shuffled once, by the region, and both ends are found
    there. Only the others, if there are any, are shuffled for each end.
    """
    columns = df.columns
    usable = usable_blocks(blocks, allowed)
    segments = freeze(lift_segments(usable), "segments", measured=True)
    small = fits_broadcast(segments) if small is None else small
    of_any = F.col("within") == ANY_CHROMOSOME
    over_all, by_chrom = (segments.where(c).drop("preference", "within") for c in (of_any, ~of_any))

    def placed(joined: DataFrame, end: str, output: str) -> DataFrame:
        position = F.col(end) - 1
        return (
            joined.where((F.col("seg_start") <= position) & (position < F.col("seg_end")))
            .withColumn(output, F.col("offset") + F.col("sign") * position + 1)
            .drop("_bin", "seg_start", "seg_end", "offset", "sign")
        )

    def one_by_one(rows: DataFrame, once: bool) -> DataFrame:
        rows = rows.withColumn("_bin", _bin(F.col("start") - 1))
        rows = placed(lookup_join(rows, over_all, ["chrom", "_bin"], "inner", small, once=once), "start", "_a")
        rows = rows.withColumn("_bin", _bin(F.col("end") - 1))
        keys = ["chrom", "_bin", "new_chrom"]
        return placed(lookup_join(rows, by_chrom, keys, "inner", small, once=True), "end", "_b")

    df = df.withColumn("chrom", strip_chr("chrom"))
    if small:
        both = one_by_one(df, True)
    else:
        df = freeze(df, "unlifted")  # read for the rows with both ends in a region, for the others, and for counts
        region, end_bin = _region(_bin(F.col("start") - 1)), _bin(F.col("end") - 1)
        first, after = (F.call_function("shiftleft", n, F.lit(REGION_BITS)) for n in (region, region + 1))
        in_region = (first <= end_bin) & (end_bin <= after)
        both = placed_together(df.where(in_region).withColumn("_region", region), over_all, by_chrom, placed)
        others = df.where(~in_region)
        if not others.isEmpty():
            both = both.unionByName(one_by_one(others, False))
    drift = F.abs(F.abs(F.col("start") - F.col("end")) - F.abs(F.col("_a") - F.col("_b")))
    new = {
        "chrom": F.col("new_chrom"),
        "start": F.least("_a", "_b"),
        "end": F.greatest("_a", "_b"),
    }
    return both.where(drift <= maxdiff).select(
        [new[name].alias(name) if name in new else F.col(name) for name in columns]
    )


def unmatched_chromosomes(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """``chrom, rows``: chromosomes of ``df`` for which there is no chain, and how many rows they have."""
    counted = df.groupBy(strip_chr("chrom").alias("chrom")).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(blocks.select(strip_chr("src_chrom").alias("chrom")).distinct(), "chrom", "left_anti")
