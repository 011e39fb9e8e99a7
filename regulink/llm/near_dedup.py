"""Near-duplicate groups by min-max hashing, with every link confirmed on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regulink.llm.common import table, text_chunks, texts, with_ids, without_ids
from regulink.llm.components import components
from regulink.llm.wordhash import classes_of, mix, words_of
from regulink.session import freeze

BAND_ROWS = 6
DOCUMENTS_PER_FILE = 50_000  # of tables written on the way
MISS = 1e-5  # chance that a pair just at the threshold meets in no band
SMALL_BUCKET = 32  # members of a bucket that are compared each with each
BLOCK = 256  # sets that are compared with one at a time
SIZE_STEPS = 10  # of the logarithm of set sizes
_BYTES = classes_of(b" \t\n\r\x0b\x0c")
_ODD = 0x9E3779B97F4A7C15


def bands_for(percent: int, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands that a pair of ``percent`` similarity misses altogether with the given chance."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def shingles(values: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text, and where each text's begin.

    A-Z are lower-cased; words are what stands between ASCII white space. A text with fewer words
    than a shingle has its whole sequence as one; a text without words has none.
    """
    found = words_of([v.encode("utf-8", "replace").lower() for v in values], _BYTES)
    hashes, first = found.hashes, found.first
    factors = [np.uint64(pow(_ODD, j + 1, 1 << 64)) for j in range(words)]
    n = np.diff(first)
    with np.errstate(over="ignore"):
        long = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for j in range(words):
            long += hashes[j : j + len(long)] * factors[j]
        long = mix(long)
        parts = []
        for k in range(len(n)):
            if n[k] >= words:
                parts.append(np.unique(long[first[k] : first[k + 1] - words + 1]))
            elif n[k]:
                own = hashes[first[k] : first[k + 1]]
                short = (own * np.array(factors[: len(own)], np.uint64)).sum(dtype=np.uint64)
                parts.append(mix(np.array([short + np.uint64(len(own))], np.uint64)))
            else:
                parts.append(np.zeros(0, np.uint64))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.concatenate([*parts, np.zeros(0, np.uint64)]), np.concatenate([[0], np.cumsum(sizes)])


def min_max(hashes: np.ndarray, starts: np.ndarray, permutations: int, seed: int = 1) -> np.ndarray:
    """Minimum and maximum of each set under each permutation: two values from one evaluation."""
    dealt = np.random.default_rng(seed)
    factors = dealt.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = dealt.integers(0, 1 << 63, permutations, np.uint64)
    kept = np.empty((2 * permutations, len(starts)), np.uint64)
    moved = np.empty_like(hashes)
    with np.errstate(over="ignore"):
        for k in range(permutations):
            np.multiply(hashes, factors[k], out=moved)
            moved += shifts[k]
            np.minimum.reduceat(moved, starts, out=kept[2 * k])
            np.maximum.reduceat(moved, starts, out=kept[2 * k + 1])
    return kept


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band and set; keys of different bands are apart."""
    keys = np.empty((bands, signature.shape[1]), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            key = np.full(signature.shape[1], band + 1, np.uint64)
            for row in signature[band * rows : (band + 1) * rows]:
                key = mix(key * np.uint64(_ODD) + row)
            keys[band] = key
    return keys


def signatures(df: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands`` of each text; no key and no bands for an empty set."""
    bands = bands_for(percent)
    permutations = -(-bands * BAND_ROWS // 2)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values, _ in text_chunks(batches, 500_000):
            hashes, begins = shingles(values, words)
            n = np.diff(begins)
            some = np.flatnonzero(n)
            keys, starts = [None] * len(n), begins[:-1][some]
            offsets = np.concatenate([[0], np.cumsum(bands * (n > 0))]).astype(np.int32)
            flat = np.zeros(0, np.int64)
            if len(some):
                with np.errstate(over="ignore"):
                    one = np.add.reduceat(mix(hashes ^ np.uint64(_ODD)), starts)
                    two = np.add.reduceat(mix(hashes + np.uint64(_ODD)), starts)
                pairs = np.stack([one, two], 1)
                for k, pair in zip(some.tolist(), pairs, strict=True):
                    keys[k] = pair.tobytes()
                signature = min_max(hashes, starts, permutations)
                flat = band_keys(signature, bands, BAND_ROWS).T.ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )

    return df.mapInArrow(sign, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _sets(df: DataFrame, words: int) -> DataFrame:
    """``doc_id, shingles``: the sorted distinct hashes of each text."""

    def give(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, values, _ in text_chunks(batches, 500_000):
            hashes, begins = shingles(values, words)
            listed = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids, listed], ["doc_id", "shingles"])

    return df.mapInArrow(give, "doc_id long, shingles array<long>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_b"))
    same = F.size(F.array_intersect("_a", "_b"))
    linked = (100 + percent) * same >= percent * (F.size("_a") + F.size("_b"))
    return pairs.join(left, "a").join(right, "b").where(linked).select("a", "b")


def _shared_sizes(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """``doc_id, shared``: shingles of each grouped document that another of its group has too."""
    held = sets.join(groups, "doc_id")
    alone = (
        held.select("group", "doc_id", F.explode("shingles").alias("_shingle"))
        .groupBy("group", "_shingle")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("doc_id"))
        .where("_n = 1")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("_alone"))
    )
    sized = held.select("doc_id", F.size("shingles").alias("_size"))
    return sized.join(alone, "doc_id", "left").select(
        "doc_id", (F.col("_size") - F.coalesce("_alone", F.lit(0))).alias("shared")
    )


def _may_link(percent: int, n1: str, m1: str, n2: str, m2: str):
    """Whether two sets of ``n`` shingles, ``m`` of them shared with others of the group, can link."""
    return (100 + percent) * F.least(m1, m2) >= percent * (F.col(n1) + F.col(n2))


def near_links(df: DataFrame, representatives: DataFrame, words: int, percent: int, files: int) -> DataFrame:
    """Confirmed links ``a, b`` that connect all representatives as all links between them would.

    ``representatives`` has ``doc_id, n_shingles, bands``, one row for each different set. In small
    buckets each is compared with each. In large ones all are first compared with the member that
    holds the fewest shingles of its own; then the members outside the largest component of the
    connected large buckets are compared with those of other components, in blocks.
    Shingles that no other document of the connected large buckets holds can't be in common, so
    that bound leaves out no link. Tables on the way are written as ``files`` files at
    most.
    """
    exploded = representatives.select("doc_id", "n_shingles", F.explode("bands").alias("bucket"))
    sizes = exploded.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("least")
    )
    members = freeze(exploded.join(sizes.where("size > 1"), "bucket").coalesce(files), "buckets")
    met = with_ids(df, members.select("doc_id").distinct())
    sets = freeze(_sets(met, words), "sets")

    small = members.where(F.col("size") <= SMALL_BUCKET)
    pairs = (
        small.select("bucket", F.col("doc_id").alias("a"), F.col("n_shingles").alias("_n"))
        .join(small.select("bucket", F.col("doc_id").alias("b"), F.col("n_shingles").alias("_m")), "bucket")
        .where("a < b")
        # sizes alone rule out the others
        .where(100 * F.least("_n", "_m") >= percent * F.greatest("_n", "_m"))
        .select("a", "b")
    )
    large = members.where(F.col("size") > SMALL_BUCKET)
    if large.isEmpty():
        return freeze(confirm(pairs.distinct(), sets, percent).repartition(files), "confirmed")

    groups = components(large.select(F.col("doc_id").alias("a"), F.col("least").alias("b")).distinct())
    groups = groups.select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    shared = freeze(_shared_sizes(sets, groups).repartition(files), "shared")
    large = large.join(shared, "doc_id").select("bucket", "doc_id", "n_shingles", "shared")
    clean = F.struct((1 - F.col("shared") / F.col("n_shingles")).alias("own"), "doc_id", "n_shingles", "shared")
    pivots = large.groupBy("bucket").agg(F.min(clean).alias("p"))
    pivots = pivots.select("bucket", F.col("p.doc_id").alias("_d"), F.col("p.n_shingles").alias("_n"), F.col("p.shared").alias("_m"))
    stars = (
        large.join(pivots, "bucket")
        .where("doc_id <> _d")
        .where(_may_link(percent, "n_shingles", "shared", "_n", "_m"))
        .select(F.least("doc_id", "_d").alias("a"), F.greatest("doc_id", "_d").alias("b"))
    )
    first = freeze(confirm(pairs.union(stars).distinct(), sets, percent).repartition(files), "confirmed")

    placed = freeze(_placed(components(first), groups, shared, representatives).repartition(files), "placed")
    second = _outside_links(placed, sets, percent)
    return first.union(freeze(second.repartition(files), "confirmed"))


def _placed(parts: DataFrame, groups: DataFrame, shared: DataFrame, representatives: DataFrame) -> DataFrame:
    """Members of groups with their component so far and a step number of their size."""
    return (
        groups.join(shared, "doc_id")
        .join(representatives.select("doc_id", "n_shingles"), "doc_id")
        .join(parts.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
        .withColumn("step", F.floor(F.ln("n_shingles") * SIZE_STEPS).cast("int"))
    )


def _outside_links(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of group members outside their group's largest component to members of other components.

    Members are laid in blocks of about ``BLOCK`` sets of like size. A member outside that can still
    link is sent to the blocks of possible sizes and compared there, with those of the block with
    which a link is possible; only links come out.
    """
    mains = placed.groupBy("group", "component").agg(F.count(F.lit(1)).alias("_rows"), F.min("n_shingles").alias("_least"))
    mains = mains.groupBy("group").agg(
        F.max(F.struct("_rows", "component")).alias("_main"), F.min("_least").alias("_least"), F.count(F.lit(1)).alias("_parts")
    )
    mains = mains.where("_parts > 1").select("group", F.col("_main.component").alias("_main"), "_least")
    outside = (
        placed.join(mains, "group")
        .where("component <> _main")
        .where((100 + percent) * F.col("shared") >= percent * (F.col("n_shingles") + F.col("_least")))
        .select(
            "group", F.col("doc_id").alias("_d"), F.col("n_shingles").alias("_n"),
            F.col("shared").alias("_m"), F.col("component").alias("_c"), F.col("step").alias("_s"),
        )
    )
    sizes = placed.join(mains.select("group"), "group").groupBy("group", "step").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_blocks"))
    block = F.pmod(F.xxhash64("doc_id"), "_blocks").alias("block")
    member = F.struct("doc_id", "component", "n_shingles", "shared", "shingles")
    blocks = (
        placed.join(sizes, ["group", "step"])
        .select("group", "step", block, "doc_id", "component", "n_shingles", "shared")
        .join(sets, "doc_id")
        .groupBy("group", "step", "block")
        .agg(F.collect_list(member).alias("members"))
    )
    far = math.ceil(SIZE_STEPS * math.log(100 / percent)) + 1
    sent = (
        outside.join(sizes, "group")
        .where(F.abs(F.col("step") - F.col("_s")) <= far)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("block"))
        .join(sets.select(F.col("doc_id").alias("_d"), F.col("shingles").alias("_shingles")), "_d")
    )
    need = lambda c: percent * (c["n_shingles"] + F.col("_n"))
    linked = F.filter(
        "members",
        lambda c: (c["component"] != F.col("_c"))
        & ((100 + percent) * F.least(c["shared"], F.col("_m")) >= need(c))
        & ((100 + percent) * F.size(F.array_intersect(c["shingles"], F.col("_shingles"))) >= need(c)),
    )
    met = sent.join(blocks, ["group", "step", "block"]).select("_d", linked.alias("_linked"))
    links = met.select("_d", F.explode(F.transform("_linked", lambda c: c["doc_id"])).alias("_e"))
    ends = links.select(F.least("_d", "_e").alias("a"), F.greatest("_d", "_e").alias("b")).distinct()
    return ends


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row.

    Documents are linked when ``100 * intersection >= percent * union`` of their shingle sets. Equal
    sets are one node; links between different ones come from min-max bands and are confirmed on
    whole sets. ``component_id`` is the smallest id reachable, ``kept`` marks the row that has it.
    Null and empty texts have no shingles and are linked with nothing. Rows that repeat an id are one
    document, linked by any of its texts; a row without an id is linked with nothing, has no component
    and is kept.
    """
    given = texts(df, id_col, text_col)
    signed = freeze(signatures(given, words, percent), "signatures")
    files = 1 + signed.count() // DOCUMENTS_PER_FILE
    with_set = signed.where("set_key is not null and doc_id is not null")
    classes = with_set.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    classes = freeze(classes.repartition(files), "classes")
    representatives = with_set.join(classes, ["set_key", "doc_id"]).dropDuplicates(["doc_id", "set_key"])
    links = near_links(given, representatives.select("doc_id", "n_shingles", "bands"), words, percent, files)
    # the texts of one id are one node, also where a smaller id stands for one of them
    own = with_set.join(classes.withColumnRenamed("doc_id", "_first"), "set_key").where("doc_id <> _first")
    several = with_set.groupBy("doc_id").agg((F.min("set_key") < F.max("set_key")).alias("_several")).where("_several")
    several = freeze(several.select("doc_id"), "several")
    if not several.isEmpty():
        one = own.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("_first").alias("b"))
        links = links.union(one.distinct())
    found = components(links).select(F.col("node").alias("doc_id"), "component")
    of_set = classes.join(found, "doc_id", "left").select(
        "set_key", F.coalesce("component", "doc_id").alias("component")
    )
    joined = signed.drop("bands").join(of_set, "set_key", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of one document of each group. Rows without an id stay.

    Different texts of one id are documents of their own here, so that none is lost with another:
    the smallest text goes by the id, the others come after all ids. Of rows that repeat an id and its
    text one stays.
    """
    known = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    repeated = freeze(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "ids")
    if repeated.isEmpty():
        found = near_duplicates(df, words, percent, id_col, text_col)
        return without_ids(df, found.where(~F.col("kept")).select("doc_id").distinct(), id_col)

    by_text = known.join(repeated, "doc_id", "left_semi").distinct()
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("_text"))
    last = known.agg(F.max("doc_id")).scalar()
    named = by_text.withColumn("_first", place == 1).select(
        "doc_id", "_text", F.when(F.col("_first"), F.col("doc_id")).otherwise(last + 1 + F.monotonically_increasing_id()).alias("_node")
    )
    named = freeze(named, "nodes")  # numbers must not change
    once = without_ids(df, repeated, id_col)
    judged = once.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).union(
        named.select("_node", "_text")
    )
    found = near_duplicates(judged, words, percent)
    gone = freeze(found.where(~F.col("kept")).select("doc_id").distinct(), "removed")
    stays = named.join(gone.withColumnRenamed("doc_id", "_node"), "_node", "left_anti")
    columns = df.columns
    again = with_ids(df, repeated, id_col).withColumn("_place", F.row_number().over(W.partitionBy(id_col, text_col).orderBy(F.lit(0))))
    met = stays.select(F.col("doc_id").alias("_of"), F.col("_text").alias("_same"))
    on = (F.col(id_col).cast("long") == F.col("_of")) & F.col(text_col).eqNullSafe(F.col("_same"))
    kept = again.where("_place = 1").join(met, on, "left_semi").select(*columns)
    return without_ids(once, gone, id_col).unionByName(kept)


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=3, percent=85)
