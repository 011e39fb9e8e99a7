"""Scoring of variant-gene evidence."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regulink.fixed_values import (
    CONSEQUENCE_FEATURE,
    CONSEQUENCE_TYPE,
    FEATURE_WEIGHTS,
    INTERVAL_TYPES,
    QTL_TYPES,
    SOURCE_WEIGHTS,
)
from regulink.functions import clean_score
from regulink.operators.joins import group_join, lookup_join
from regulink.operators.ranking import bin_borders, bin_of_rank, exact_quantiles, last_of_bin, tie_of
from regulink.session import freeze, same_sizes, sizes_of

COPY_RUN = 100_000  # exact copies of a row that one task writes out
FEATURE_KEYS = ("source_id", "feature")
GENE_KEYS = ("variant_id", "source_id", "gene_name")


def weights_frame(spark, weights: Mapping[str, float | None]) -> DataFrame:
    """A ``term, weight`` table from a dictionary."""
    table = F.create_map(
        *[
            F.lit(x).cast(kind)
            for pair in weights.items()
            for x, kind in zip(pair, ("string", "double"))
        ]
    )
    return spark.range(1).select(F.explode(table).alias("term", "weight"))


def evidence_score(
    df: DataFrame,
    weights: DataFrame,
    qtl_types: Sequence[str] = tuple(QTL_TYPES),
    on_unknown: str = "error",
) -> DataFrame:
    """Add ``score``, by evidence type.

    Interval types take the interval score, with 0 as missing; consequences take the weight of
    their term, where an unknown term, or one with several weights, is an error; QTL types take one minus the p-value. Any other
    type is an error, or null with ``on_unknown='null'``.
    """
    differ = F.countDistinct(F.coalesce("weight", F.lit(-1.0))) > 1
    twice = F.raise_error(F.concat(F.lit("several weights for term: "), F.coalesce("_term", F.lit("null"))))
    lookup = (
        weights.groupBy(F.col("term").alias("_term"))
        .agg(F.max("weight").alias("_weight"), differ.alias("_differ"))
        .select("_term", F.when(F.col("_differ"), twice.cast("double")).otherwise(F.col("_weight")).alias("_weight"))
    )
    lookup = lookup.withColumn("_known", F.lit(True))
    kind = F.col("type_id")
    is_consequence = kind == CONSEQUENCE_TYPE
    joined = lookup_join(
        df.withColumn("_term", F.when(is_consequence, F.col("feature"))), lookup, ["_term"], "left"
    )
    unknown_term = F.raise_error(
        F.concat(F.lit("no weight for term: "), F.coalesce("feature", F.lit("null")))
    )
    score = (
        F.when(kind.isin(INTERVAL_TYPES), F.nullif(F.col("interval_score"), F.lit(0.0)))
        .when(is_consequence & F.col("_known").isNull(), unknown_term.cast("double"))
        .when(is_consequence, F.col("_weight"))
        .when(kind.isin(list(qtl_types)), F.lit(1.0) - F.col("qtl_pval"))
    )
    if on_unknown == "error":
        message = F.concat(F.lit("unknown evidence type: "), F.coalesce(kind, F.lit("null")))
        score = score.otherwise(F.raise_error(message).cast("double"))
    return (
        joined.withColumn("score", score)
        .withColumn("score", clean_score("score"))
        .drop("_term", "_weight", "_known")
    )


def wipe_consequence_feature(df: DataFrame) -> DataFrame:
    """Put all consequence rows in one group."""
    return df.withColumn(
        "feature",
        F.when(F.col("type_id") == CONSEQUENCE_TYPE, CONSEQUENCE_FEATURE).otherwise(
            F.col("feature")
        ),
    )


def _grid_pieces(grids: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Quantile grids as pieces of a function from value to position, one per distinct grid value.

    On a grid value the position is the middle of the grid points equal to it, but 0 on the lowest
    and 1 on the highest; from there to the next grid value it is interpolated.
    """
    next_value = F.lead("_from").over(Window.partitionBy(*by).orderBy("_from"))
    middle = (F.col("_first") + F.col("_last")) / F.lit(2.0) / F.lit(n - 1)
    return (
        grids.select(*by, "n", F.posexplode("quantiles").alias("_i", "_from"))
        .groupBy(*by, "n", "_from")
        .agg(F.min("_i").alias("_first"), F.max("_i").alias("_last"))
        .select(
            *by,
            "n",
            "_from",
            next_value.alias("_to"),
            F.when(F.col("_first") == 0, 0.0)
            .when(F.col("_last") == n - 1, 1.0)
            .otherwise(middle)
            .alias("_at"),
            "_last",
        )
    )


def _with_group(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    data = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    for key in by:
        data = data.where(F.col(key).isNotNull())
    return data


def fit_quantile_grids(
    df: DataFrame, n: int, by: Sequence[str] = FEATURE_KEYS, value: str = "score"
) -> DataFrame:
    """The ``n``-point quantile grid of each group, as pieces of a function from value to position:
    ``by, points, fitted_rows, pieces``. One row a group, so the table can be kept and applied later."""
    grids = exact_quantiles(_with_group(df, value, by), value, [Fraction(i, n - 1) for i in range(n)], by)
    piece = F.struct("_from", "_to", "_at", "_last")
    pieces = _grid_pieces(grids, by, n).groupBy(*by).agg(
        F.first("n").alias("fitted_rows"), F.sort_array(F.collect_list(piece)).alias("pieces")
    )
    return pieces.select(*by, F.lit(n).alias("points"), "fitted_rows", "pieces")


def apply_quantile_grids(
    df: DataFrame,
    grids: DataFrame,
    by: Sequence[str] = FEATURE_KEYS,
    value: str = "score",
    output: str = "score_scaled",
    on_unknown: str = "error",
    most: int | None = None,
) -> DataFrame:
    """Add each value's position on the grid of its group, from :func:`fit_quantile_grids`.

    ``df`` is read once. It may be a slice of what the grids were fitted on, or new rows: a value
    below the grid has position 0, one above it 1. Rows with a missing value or group key are left
    out. A group without a grid is an error, or left out with ``on_unknown='drop'``.
    """
    grids = freeze(grids, "grid", measured=True) if sizes_of(grids) is None else grids
    most = most or grids.agg(F.max("points")).first()[0] or 1
    kept = grids.select(*by, F.col("points").alias("_points"), F.col("pieces").alias("_pieces"))
    x, found = F.col(value), F.get("_pieces", F.col("_piece"))
    start, end = found["_from"], found["_to"]
    # of the last piece there is no end: its position is that of its start
    between = (found["_last"] + (x - start) / (end - start)) / (F.col("_points") - 1)
    position = F.when(F.col("_piece") < 0, 0.0).when((x == start) | end.isNull(), found["_at"]).otherwise(between)
    # a grid of one value puts it at 0, what is above it at 1
    position = F.when((F.size("_pieces") == 1) & (x > start), 1.0).otherwise(position)
    met = lookup_join(_with_group(df, value, by), same_sizes(kept, grids), by, "inner" if on_unknown == "drop" else "left")
    if on_unknown == "error":
        named = F.concat_ws("/", *by)
        missing = F.raise_error(F.concat(F.lit("no quantile grid for: "), named)).cast("double")
        position = F.when(F.col("_pieces").isNull(), missing).otherwise(position)
    return (
        met.withColumn("_piece", _last_at_or_below("_pieces", "_from", x, most))
        .withColumn(output, position)
        .drop("_pieces", "_piece", "_points")
    )


def quantile_scale(
    df: DataFrame,
    n: int,
    by: Sequence[str] = FEATURE_KEYS,
    value: str = "score",
    output: str = "score_scaled",
) -> DataFrame:
    """Add each value's position on the ``n``-point quantile grid of its group.

    Rows with a missing value or group key take no part and are left out. A row meets one row, that
    of its group with the grid as an array. ``df`` is read twice, for the grids and for the rows,
    which costs less than writing it; with kept grids it is read once.
    """
    grids = freeze(fit_quantile_grids(df, n, by, value), "grid", measured=True)
    return apply_quantile_grids(df, grids, by, value, output, "drop", n)


def _halved(entries: str, most: int, passed: Callable[[Column], Column]) -> Column:
    """How many of at most ``most`` sorted entries ``passed`` is true of: the first ones.

    The number is found by halving, so a row looks at few entries however many there are.
    """
    steps = [1 << k for k in reversed(range(most.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(
            (at + s <= F.size(entries)) & passed(F.get(entries, at + s - 1)), at + s
        ).otherwise(at),
    )


def _last_at_or_below(entries: str, field: str, x: Column, most: int) -> Column:
    """Index of the last of the sorted entries whose field is not above ``x``, or -1."""
    return _halved(entries, most, lambda entry: entry[field] <= x) - 1


def _number_below(entries: str, field: str, x: Column, most: int) -> Column:
    """How many of the sorted entries have a field below ``x``; 0 without entries."""
    return F.coalesce(_halved(entries, most, lambda entry: entry[field] < x), F.lit(0))


def quantile_bins(
    df: DataFrame,
    bins: int = 10,
    by: Sequence[str] = FEATURE_KEYS,
    order: Sequence[str] = ("score",),
    output: str = "bin",
) -> DataFrame:
    """Add the number (from 1) of the equal-sized bin a row falls in, in ``order`` within its group.

    When the rows do not divide evenly the first bins hold one more. Rows with a missing group key
    are left out. Rows that are equal in ``order`` are taken by a hash of their content.

    The rows are neither sorted nor written. A first pass reads the keys and finds where the bins
    end; in a second one a row meets the borders of its group and finds its bin by halving. Only
    exact copies of one row can lie on both sides of a border: these are counted, and dealt out by
    number (there, as in any grouping, -0.0 is 0.0).
    """
    columns, by = df.columns, list(by)
    data = df
    for key in by:
        data = data.where(F.col(key).isNotNull())
    if bins == 1:
        return data.withColumn(output, F.lit(1))
    data = data.withColumn("_tie", tie_of(columns))
    keys = [*order, "_tie"]
    borders = bin_borders(data.select(*dict.fromkeys([*by, *keys])), bins, by, keys)
    own = F.struct(*keys)
    met = lookup_join(data, borders, by, "left").withColumn("_passed", _number_below("_borders", "key", own, bins))
    at_border = F.get("_borders", F.col("_passed"))
    on_cut = F.coalesce((at_border["key"] <= own) & at_border["cut"], F.lit(False))
    # no bin ends between the last border key that is below the row and the row
    last = F.get("_borders", F.col("_passed") - 1)
    number = F.when(F.col("_passed") == 0, 1).otherwise(bin_of_rank(last["before"] + last["rows"], last["total"], bins))
    clear = met.where(~on_cut).select(*columns, number.alias(output))
    cut = borders.where(F.exists("_borders", lambda b: b["cut"]))
    if cut.isEmpty():
        return clear
    place = F.struct(at_border["before"].alias("before"), at_border["total"].alias("total"))
    copies = met.where(on_cut).groupBy(*columns, place.alias("_place")).agg(F.count(F.lit(1)).alias("_copies"))
    return clear.unionByName(_deal_copies(copies, by, columns, bins, output))


def _deal_copies(copies: DataFrame, by: Sequence[str], columns: Sequence[str], bins: int, output: str) -> DataFrame:
    """Rows that are one key of a border, counted as ``_copies``: each bin gets its number of them.

    Different rows can share a key only if their hashes collide; they then follow one another.
    """
    earlier = Window.partitionBy("_place", *by).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("_place.before") + F.coalesce(F.sum("_copies").over(earlier), F.lit(0))
    total = F.col("_place.total")
    spans = (
        copies.withColumn("_begin", begin)
        .withColumn("_end", F.col("_begin") + F.col("_copies"))
        .withColumn(
            output,
            F.explode(F.sequence(bin_of_rank(F.col("_begin"), total, bins), bin_of_rank(F.col("_end") - 1, total, bins))),
        )
    )
    first, last = last_of_bin(F.col(output) - 1, total, bins) + 1, last_of_bin(F.col(output), total, bins) + 1
    number = F.least(F.col("_end"), last) - F.greatest(F.col("_begin"), first)
    # many copies come out of several tasks
    runs = spans.withColumn("_number", number).withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_number - 1) div {COPY_RUN}")))
    )
    size = F.least(F.lit(COPY_RUN).cast("long"), F.col("_number") - F.col("_run") * COPY_RUN)
    return (
        runs.repartition("_run", output)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
        .select(*columns, F.col(output).cast("int").alias(output))
    )


def per_source_scores(df: DataFrame, counts: bool = False, ids: bool = False) -> DataFrame:
    """Best scaled score of each (variant, source, gene), and on request how many there are.

    ``ids`` adds the ``gene_id`` of the name, the first in order where a name has several, and the
    number of rows as ``_rows``.
    """
    aggregates = [F.max("score_scaled").alias("ft_max")]
    if counts:
        aggregates.append(F.count("score_scaled").alias("ft_count"))
    if ids:
        aggregates += [F.min("gene_id").alias("gene_id"), F.count(F.lit(1)).alias("_rows")]
    keyed = df
    for key in GENE_KEYS:
        keyed = keyed.where(F.col(key).isNotNull())
    return keyed.groupBy(*GENE_KEYS).agg(*aggregates)


def minmax(
    df: DataFrame,
    col: str = "ft_count",
    by: Sequence[str] = ("variant_id", "source_id"),
    output: str = "ft_count_scaled",
    one_row_per_gene: bool = False,
) -> DataFrame:
    """Scale to 0..1 within a group; a group with one value gives 0.

    The extremes are aggregated with partial results and joined back. When the caller knows that a
    group has one row per gene, and so is small, a window saves those shuffles.
    """
    low, high = F.col("_low"), F.col("_high")
    if one_row_per_gene:
        group = Window.partitionBy(*by)
        ranged = df.withColumns({"_low": F.min(col).over(group), "_high": F.max(col).over(group)})
    else:
        extremes = df.groupBy(*by).agg(
            F.min(col).alias("_low"), F.max(col).alias("_high"), F.count(F.lit(1)).alias("_rows")
        )
        ranged = group_join(df, extremes, by)
    position = F.try_divide((F.col(col) - low).cast("double"), high - low)
    return ranged.withColumn(
        output, F.when(F.col(col).isNotNull(), F.coalesce(position, F.lit(0.0)))
    ).drop("_low", "_high")


def melt_scores(df: DataFrame, columns: Sequence[str], value: str = "value") -> DataFrame:
    """One row per score type; missing scores are left out."""
    return df.unpivot(
        ids=list(GENE_KEYS),
        values=[F.col(c).cast("double").alias(c) for c in columns],
        variableColumnName="score_type",
        valueColumnName=value,
    ).where(F.col(value).isNotNull())


def _weight_of(key: Column, weights: Mapping[str, float], what: str) -> Column:
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    missing = F.raise_error(F.concat(F.lit(f"no weight for {what}: "), F.coalesce(key, F.lit("null"))))
    return F.coalesce(F.try_element_at(table, key), missing.cast("double"))


def _weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(weight))


def feature_aggregate(
    long_scores: DataFrame,
    weights: Mapping[str, Mapping[str, float]] | None = None,
    value: str = "value",
) -> DataFrame:
    """Weighted mean over score types, with weights by source and score type."""
    table = {
        f"{source}/{kind}": float(weight)
        for source, kinds in (FEATURE_WEIGHTS if weights is None else weights).items()
        for kind, weight in kinds.items()
    }
    weight = _weight_of(F.concat("source_id", F.lit("/"), "score_type"), table, "score type")
    return long_scores.groupBy(*GENE_KEYS).agg(
        _weighted_mean(F.col(value), weight).alias("ft_agg")
    )


def variant_gene_scores(
    per_source: DataFrame,
    weights: Mapping[str, float] | None = None,
    value: str = "score",
    ids: bool = False,
) -> DataFrame:
    """Weighted mean over the sources present for a (variant, gene); ``ids`` keeps ``gene_id``."""
    table = {k: float(w) for k, w in (SOURCE_WEIGHTS if weights is None else weights).items()}
    weight = _weight_of(F.col("source_id"), table, "source")
    return per_source.groupBy("variant_id", "gene_name").agg(
        _weighted_mean(F.col(value), weight).alias("src_agg"),
        *([F.min("gene_id").alias("gene_id")] if ids else []),
    )


def rank_genes(
    scores: DataFrame,
    by: Sequence[str] = ("variant_id",),
    score: str = "src_agg",
    gene: str = "gene_name",
    output: str = "rank",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rank genes by score, highest first, equal scores sharing a rank.

    Scores are first reduced to one per gene, so a window holds at most one row per known gene.
    They count as equal to twelve decimals, so ranks don't depend on the order means were summed in.
    ``carry`` names columns kept with a gene, the least value where there are several.
    """
    kept = [F.min(c).alias(c) for c in carry]
    best = scores.groupBy(*by, gene).agg(F.max(score).alias(score), *kept)
    order = Window.partitionBy(*by).orderBy(F.round(score, 12).desc_nulls_last())
    return best.withColumn(output, F.rank().over(order))
