"""URL rules and a Bloom filter cascade: exact membership of hosts without joins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.llm.common import table
from regulink.operators.joins import salt_of, skew_join
from regulink.session import freeze

# Rules as (host, path prefix, verdict), given with the task.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# Kinds of hosts that the block list holds. The first stand anywhere in a host's name,
# the others are a whole part of it, between dots and hyphens, with or without an s at the end.
LISTED_WORDS = ("spam", "pills", "casino")
LISTED_PARTS = (
    # advertising and tracking
    "ad", "adserver", "adservice", "advert", "analytics", "banner", "beacon", "clickbait", "doubleclick", "popunder",
    "popup", "telemetry", "track", "tracker", "tracking",
    # gambling
    "bet", "betting", "bingo", "blackjack", "bookmaker", "gambling", "jackpot", "lottery", "lotto", "poker", "roulette",
    "slot", "sportsbook", "wager",
    # adult
    "adult", "camgirl", "erotic", "escort", "hentai", "milf", "nsfw", "nude", "porn", "sex", "webcam", "xxx",
    # medicine and fraud
    "cialis", "malware", "pharma", "phishing", "ponzi", "ransomware", "scam", "viagra", "virus", "warez", "xanax",
)
LISTED_PATTERN = "|".join(LISTED_WORDS) + "|(^|[.-])(" + "|".join(LISTED_PARTS) + ")s?([.-]|$)"

BITS_PER_KEY = 12
HASHES = 4
SHARD_KEYS = 200_000  # keys that one cascade holds on average
BROADCAST_MAX_BYTES = 64 << 20
PROBE_SALTS = 64
MAX_LEVELS = 64


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    whole = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rule(
    host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES
) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, null where none does.

    A rule fits its host and all subdomains when the path starts with the rule's path. The length
    is that of host and path together; of equal ones the longer host wins.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, prefix, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        mine = F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, mine).otherwise(found)
    return found


def key_hashes(key: Column) -> list[Column]:
    """Two independent 64-bit hashes of a key: one for the shard, both for the bits."""
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(key, F.lit(7)).alias("_h2")]


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit positions, one row for each hash function, different at every level."""
    a, b = h1.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        turns = np.arange(HASHES, dtype=np.uint64) + np.uint64(HASHES * level + 1)
        mixed = a[None, :] + turns[:, None] * b[None, :]
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(11)) % np.uint64(bits)


def _bloom(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    bits = np.zeros(max(64, -(-BITS_PER_KEY * len(h1) // 64) * 64), bool)
    bits[_positions(h1, h2, level, len(bits)).astype(np.int64)] = True
    return np.packbits(bits)


def _inside(filter_: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    at = _positions(h1, h2, level, 8 * len(filter_)).astype(np.int64)
    return ((filter_[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(0)


def build_cascade(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[np.ndarray]:
    """Filters of one shard: level 1 holds the listed keys, level 2 the keys of the universe that
    pass level 1 without being listed, level 3 the listed keys that pass level 2, and so on."""
    filters: list[np.ndarray] = []
    inside, outside = (h1[listed], h2[listed]), (h1[~listed], h2[~listed])
    while len(inside[0]):
        if len(filters) == MAX_LEVELS:
            raise ValueError("two keys of the universe have the same hashes")
        filters.append(_bloom(*inside, len(filters)))
        passed = _inside(filters[-1], *outside, len(filters) - 1)
        inside, outside = (outside[0][passed], outside[1][passed]), inside
    return filters


def probe(filters: Sequence[np.ndarray], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Membership: a key is listed when the first level it fails is of even number (from 1)."""
    first = np.full(len(h1), len(filters))
    still = np.arange(len(h1))
    for level, one in enumerate(filters):
        passed = _inside(one, h1[still], h2[still], level)
        first[still[~passed]] = level
        still = still[passed]
    return first % 2 == 1


def cascades(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``shard, shards, filters``: one cascade for each shard of the distinct keys.

    ``universe`` has ``key, listed``: every key that will ever be asked for, once or repeated; a key
    is listed when any of its rows says so, and null keys are no keys. Shards are cut by a hash of
    the key, so that each holds about ``shard_keys`` keys whatever the universe's size.
    """
    keys = (
        universe.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
        .select(*key_hashes(F.col("key")), "listed")
    )
    keys = freeze(keys, "url-keys")
    shards = max(1, -(-keys.count() // shard_keys))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = part["_h1"].to_numpy(), part["_h2"].to_numpy()
        filters = build_cascade(h1, h2, part["listed"].to_numpy(bool))
        return pd.DataFrame(
            {"shard": [part["shard"].iloc[0]], "filters": [[f.tobytes() for f in filters]]}
        )

    return (
        keys.withColumn("shard", F.pmod("_h1", F.lit(shards)).cast("long"))
        .groupBy("shard")
        .applyInPandas(build, "shard long, filters array<binary>")
        .withColumn("shards", F.lit(shards).cast("long"))
    )


def _ask(filters_of, shards: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    said = np.zeros(len(h1), bool)
    shard = h1 % shards
    for k in np.unique(shard):
        own = shard == k
        said[own] = probe(filters_of(int(k)), h1[own], h2[own])
    return said


def add_membership(
    df: DataFrame, key: str, filters: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Add ``listed``: whether the row's key is in the list; false for null keys.

    Filters whose measured size is within ``max_bytes`` are broadcast. Larger ones stay apart: rows
    are dealt over (shard, salt), and each such part meets the one cascade of its shard.
    """
    filters = freeze(filters, "cascades")
    size = F.aggregate("filters", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x))
    total, shards, rows = filters.agg(F.sum(size), F.max("shards"), F.count(F.lit(1))).first()
    if not rows:
        return df.withColumn("listed", F.lit(False))
    hashed = df.select("*", *key_hashes(F.col(key)))
    own_columns = df.columns
    names = [*own_columns, "listed"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", listed boolean"

    def answer(batch: pa.RecordBatch, filters_of) -> pa.RecordBatch:
        h1, h2 = batch.column("_h1").to_numpy(), batch.column("_h2").to_numpy()
        said = _ask(filters_of, shards, h1, h2) & batch.column(key).is_valid().to_numpy(False)
        columns = [batch.column(c) for c in own_columns]
        return pa.RecordBatch.from_arrays([*columns, pa.array(said)], names)

    if total <= max_bytes:
        held = df.sparkSession.sparkContext.broadcast(
            {r["shard"]: [bytes(f) for f in r["filters"]] for r in filters.collect()}
        )

        def ask_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            views = {k: [np.frombuffer(f, np.uint8) for f in v] for k, v in held.value.items()}
            for batch in batches:
                yield answer(batch, lambda k: views.get(k, ()))

        return hashed.mapInArrow(ask_all, kinds)

    salted = hashed.withColumn("shard", F.pmod("_h1", F.lit(shards))).withColumn(
        "_salt", salt_of(df.columns, PROBE_SALTS).cast("long")
    )
    copies = filters.select(
        "shard", "filters", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PROBE_SALTS - 1).cast("long"))).alias("_salt")
    )

    def ask_shard(left: pa.Table, right: pa.Table) -> pa.Table:
        own = [np.frombuffer(f, np.uint8) for f in right.column("filters")[0].as_py()] if right.num_rows else ()
        parts = [answer(b, lambda _: own) for b in left.to_batches() if b.num_rows]
        return pa.Table.from_batches(parts, pa.schema([*left.select(own_columns).schema, pa.field("listed", pa.bool_())]))

    return (
        salted.groupBy("shard", "_salt")
        .cogroup(copies.groupBy("shard", "_salt"))
        .applyInArrow(ask_shard, kinds)
    )


def with_parents(host: Column) -> Column:
    """The host and every domain above it: ``a.b.c``, ``b.c``, ``c``."""
    parts = F.split(host, "[.]", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), ".")
    )


def listed_hosts(hosts: DataFrame, block_list: DataFrame) -> DataFrame:
    """``key, listed``: distinct hosts of ``hosts`` (one column ``key``), and whether ``block_list``
    (one column ``host``, compared without case, of any size) has them or a domain above them.

    Domains are made distinct before they meet the list, so a domain with many hosts is one row.
    The empty host is on no list.
    """
    keys = hosts.where(F.col("key").isNotNull()).distinct()
    above = keys.select("key", F.explode(with_parents(F.col("key"))).alias("host")).where("host <> ''")
    found = above.select("host").distinct().join(block_list.select(F.lower("host").alias("host")), "host", "left_semi")
    hit = skew_join(above, found, ["host"], "inner").select("key").distinct()
    return keys.join(hit.withColumn("listed", F.lit(True)), "key", "left").select(
        "key", F.coalesce("listed", F.lit(False)).alias("listed")
    )


def judge_urls(
    pages: DataFrame,
    listed: Column | None = None,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    block_list: DataFrame | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each row.

    The longest fitting rule decides. Where none fits, the host's membership in the block list does,
    asked of a cascade over all hosts of ``pages``. ``listed`` says of a ``host`` column whether the
    list has it (default: ``LISTED_PATTERN``); the hosts of ``block_list`` (column
    ``host``) and all their subdomains are listed besides. Null urls and urls without
    ``://`` have an empty host, which no list holds, and are allowed. Repeated rows are each judged.
    """
    split = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    if listed is None:
        listed = F.col("host").rlike(LISTED_PATTERN)
    hosts = split.select(F.col("host").alias("key"), (listed & (F.col("host") != "")).alias("listed"))
    if block_list is not None:
        hosts = hosts.unionByName(listed_hosts(hosts.select("key"), block_list))
    asked = add_membership(split, "host", cascades(hosts))
    rule = match_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return asked.withColumn("_rule", rule).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", own).alias("verdict"),
    )


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))


OP5_SQL = rf"""
WITH split AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM split
), rules(name, prefix, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits AS (
  SELECT page_id, host, path, name || prefix AS rule, verdict FROM parts
  LEFT JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, prefix)
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN regexp_matches(host, '{LISTED_PATTERN}') THEN 'block' ELSE 'allow' END) AS verdict
FROM fits
QUALIFY row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule) DESC NULLS LAST) = 1
"""
