"""Document fingerprints by consistent weighted sampling over weighted words, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regulink.llm.common import table, texts
from regulink.session import freeze

SAMPLES = 24
BUCKET_ROWS, MAX_BUCKETS = 500, 100_000
_ID_BITS = 24  # of a packed sample that name the term and its level

WHITE = "[\\x20\\x09-\\x0D]+"


def _uniform(bits: Column, shift: int) -> Column:
    """A number above 0 and below 1 from 31 of the bits."""
    part = F.shiftright(bits, shift).bitwiseAND(F.lit((1 << 31) - 1).cast("long"))
    return (part.cast("double") + 0.5) / float(1 << 31)


def samples(term: str, log_weights: list[str], count: int = SAMPLES) -> list[list[Column]]:
    """For each column of log weights its ``count`` samples, as packed longs; null for null weights.

    For term and sample, r and c are Gamma(2, 1) and beta is uniform, all from hashes of the term.
    With level t = floor(ln w / r + beta), a sample's value is ln c - r (t - beta) - r; over a
    document the least one names a term and a level, and two documents agree on them as often as
    their generalised Jaccard similarity says. A packed sample has the value above its lower bits,
    which name term and level, so that the least long is the least value.
    """
    mask = F.lit((1 << _ID_BITS) - 1).cast("long")
    out: list[list[Column]] = [[] for _ in log_weights]
    for k in range(count):
        one, two, three = (F.xxhash64(F.col(term), F.lit(3 * k + j)) for j in range(3))
        r = -F.ln(_uniform(one, 0) * _uniform(one, 31))
        log_c = F.ln(-F.ln(_uniform(two, 0) * _uniform(two, 31)))
        beta = _uniform(three, 0)
        for own, weight in zip(out, log_weights, strict=True):
            level = F.floor(F.col(weight) / r + beta)
            value = ((log_c - r * (level - beta) - r + 128.0) * float(1 << 31)).cast("long")
            named = F.xxhash64(F.col(term), level).bitwiseAND(mask)
            own.append(F.shiftleft(value, _ID_BITS).bitwiseOR(named))
    return out


def bucket_of(df: DataFrame, key: str) -> Column:
    """A bucket number that falls as ``key`` rises, for buckets of about equal rows; null keys last.

    The driver gets at most ``MAX_BUCKETS`` borders, from approximate quantiles over all rows.
    """
    buckets = min(MAX_BUCKETS, max(1, -(-df.count() // BUCKET_ROWS)))
    steps = 1
    while steps < buckets:
        steps *= 2
    borders: list[int] = []
    if buckets > 1:
        shares = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
        borders = df.agg(F.percentile_approx(key, shares, F.lit(20 * buckets))).first()[0] or []
    borders = sorted(set(borders))
    if not borders:
        return F.when(F.col(key).isNull(), F.lit(1)).otherwise(F.lit(0))
    halves, step = [], steps
    while step:
        halves.append(step)
        step //= 2
    held = F.expr("array(" + ",".join(f"{b}L" for b in borders) + ")")
    # the number of borders at or below the key, by halving
    below = F.aggregate(
        F.array(*[F.lit(h) for h in halves]),
        F.lit(0),
        lambda at, h: F.when(
            (at + h <= len(borders)) & (F.get(held, at + h - 1) <= F.col(key)), at + h
        ).otherwise(at),
    )
    number = F.lit(len(borders)) - below
    return F.when(F.col(key).isNull(), F.lit(len(borders) + 1)).otherwise(number)


def _following(tops: DataFrame, heads: DataFrame) -> DataFrame:
    """``bucket, after``: the head of the bucket that follows; after the last comes the first.

    ``tops`` has each bucket's number ``_b``; only these, of which there are a bounded number, are put
    in order. ``heads`` has one row ``bucket, head`` for each bucket; its texts meet them by a join.
    """
    every = W.orderBy("_b")
    whole = every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    after = F.coalesce(F.lead("_b").over(every), F.first("_b").over(whole))
    numbers = tops.select(F.col("_b").alias("_own"), after.alias("bucket"))
    return numbers.join(heads, "bucket").select(F.col("_own").alias("bucket"), F.col("head").alias("_after"))


def with_next_text(df: DataFrame) -> DataFrame:
    """Add ``bucket``, ``place`` in it and ``next_text``, that of the row that follows by falling id.

    ``df`` has ``doc_id`` and ``text``. Rows of one id follow by rising text, rows without an id come
    last, and the very last is followed by the first. Rows meet by bucket: one shuffle. The first
    rows of buckets, one each, are looked up apart and passed on to the bucket before.
    """
    placed = df.withColumn("bucket", bucket_of(df, "doc_id"))
    inside = W.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), F.asc("text"))
    tops = placed.groupBy(F.col("bucket").alias("_b")).agg(F.max("doc_id").alias("_top"))
    first = (F.col("bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_top"))
    # at most MAX_BUCKETS + 2 rows of two numbers
    heads = placed.join(F.broadcast(tops), first).groupBy("bucket").agg(F.min("text").alias("head"))
    led = placed.select(
        "*", F.row_number().over(inside).alias("place"), F.lead("text").over(inside).alias("_next")
    )
    after = _following(tops, heads)
    return led.join(after, "bucket").select(
        *df.columns, "bucket", "place", F.coalesce("_next", "_after").alias("next_text")
    )


def likeness(a: str, b: str) -> Column:
    """Share of places at which two fingerprints (six hex digits a sample) agree."""
    pieces = [
        (F.substring(a, 6 * k + 1, 6) == F.substring(b, 6 * k + 1, 6)).cast("double") for k in range(SAMPLES)
    ]
    total = pieces[0]
    for p in pieces[1:]:
        total = total + p
    return total / SAMPLES


def _print(prefix: str) -> Column:
    """Hex of the samples; a text without words has none and one fixed fingerprint of zeros."""
    low = F.lit((1 << _ID_BITS) - 1).cast("long")
    return F.concat(
        *[
            F.coalesce(F.lpad(F.hex(F.col(f"{prefix}{k}").bitwiseAND(low)), 6, "0"), F.lit("0" * 6))
            for k in range(SAMPLES)
        ]
    )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each row's whole text and of the text edited with the next row's.

    Terms are the words between ASCII white space, weighted by how often they occur. The edited text
    has the last floor(n_chars / 3) code points replaced by the first as many of the next document.
    A null text is empty; an empty text or one of white space has no terms, its fingerprint is like
    that of another such text only. Rows that repeat an id follow each other in order of their texts.
    """
    base = texts(df, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), cut),
    )
    digest = F.sha2(F.col("edited").cast("binary"), 256)
    # the digest travels as four numbers, which are cheaper to group by than its text
    parts = [F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("long").alias(f"_d{k}") for k in range(4)]
    keys = ["bucket", "place", "doc_id", "n_chars", *(f"_d{k}" for k in range(4))]
    own = F.split("text", WHITE)
    split = with_next_text(base).withColumn("edited", edited).select(
        "bucket", "place", "doc_id", "n_chars", *parts,
        F.size(own).alias("_own"), F.concat(own, F.split("edited", WHITE)).alias("_words"),
    )
    words = split.select(*keys, "_own", F.posexplode("_words").alias("_at", "_word"))
    mine = (F.col("_at") < F.col("_own")).cast("int")
    # a text without words has one empty word, which keeps its row and has no weight
    term = F.when(F.col("_word") != "", F.xxhash64("_word"))
    weighed = (
        words.select(*keys, term.alias("term"), mine.alias("_mine"))
        .groupBy(*keys, "term")
        .agg(F.sum("_mine").alias("_a"), F.sum(1 - F.col("_mine")).alias("_b"))
        .select(*keys, "term", *[
            F.when(F.col("term").isNotNull() & (F.col(n) > 0), F.ln(n)).alias(f"_w{n}") for n in ("_a", "_b")
        ])
    )
    a, b = samples("term", ["_w_a", "_w_b"])
    sampled = weighed.groupBy(*keys).agg(
        *[F.min(c).alias(f"a{k}") for k, c in enumerate(a)],
        *[F.min(c).alias(f"b{k}") for k, c in enumerate(b)],
    )
    whole = [F.lower(F.lpad(F.hex(f"_d{k}"), 16, "0")) for k in range(4)]
    return sampled.select(
        "bucket", "place", "doc_id", "n_chars", F.concat(*whole).alias("edited_sha256"),
        _print("a").alias("fingerprint"), _print("b").alias("edited_fingerprint"),
    )


def compare_fingerprints(printed: DataFrame) -> DataFrame:
    """Add ``near_edited`` and ``near_next``: likeness to the edited text and to the next row's.

    ``printed`` comes from ``fingerprints`` and gives the same rows whenever it is read.
    """
    inside = W.partitionBy("bucket").orderBy("place")
    heads = printed.where("place = 1").select("bucket", F.col("fingerprint").alias("head"))
    after = _following(heads.select(F.col("bucket").alias("_b")), heads)
    led = printed.withColumn("_next", F.lead("fingerprint").over(inside)).join(after, "bucket")
    led = led.withColumn("_next", F.coalesce("_next", "_after"))
    return led.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "_next").alias("near_next"),
    )


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    printed = freeze(fingerprints(table(spark, folder, "documents")), "fingerprints")
    return compare_fingerprints(printed)
