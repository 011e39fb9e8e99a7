"""Collocations of words from one count of padded windows.

Each word begins one window of the longest length, laid out as lead columns ``w1, w2, ...`` and
padded where its piece of text ends. Only these windows are counted; ROLLUP then sums them over
successively shorter prefixes, which gives the frequencies of all shorter phrases, of single words
and of all words of a language.

A window is also padded where going on would make a phrase that cannot be frequent. An upper bound
on the frequency of every phrase comes first: occurrences by a hash of the phrase, in a table of fixed
size. A phrase whose bucket stays below the limit is itself below it; it is no candidate, and neither
is a longer one, so nobody asks for its frequency. So the padding changes no result, whatever the size
of the corpus; where the buckets are crowded it only saves less.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regulink.llm.common import table
from regulink.llm.wordhash import classes_of, mix, words_of
from regulink.operators.joins import skew_join
from regulink.session import freeze

LEAST, TOP, MOST_WORDS, INSIDE = 10, 2000, 3, 50
NO_LANG = "und"
SHARES = 32  # of the phrases of a language that are ranked on their own first
BUCKET_BITS = 28  # logarithm of the number of phrase buckets: 32 MB with a bit for each
RANGE_BITS = 20  # of the buckets in one row of the table
COUNTED = 1_500_000  # buckets that a task counts before it hands them on
SEGMENT = 500_000  # bytes of text that become words at a time
WINDOWS = 1_000_000  # windows that are held before they are counted
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CLASSES = classes_of(b" \t" + _BREAKS)
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(_BREAKS)] = True
_GAP = re.compile(rb"[ \t.,;:!?\n-\r]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _segments(text: bytes, ahead: int, limit: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a text, with how many bytes of each begin a window; what follows those is the rest
    of the windows, up to ``ahead`` words of the same piece. Words are never cut."""
    if len(text) <= limit:
        yield text, len(text)
        return
    rest = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % ahead)
    begin = 0
    while begin < len(text):
        gap = _GAP.search(text, begin + limit)
        end = gap.start() if gap else len(text)
        yield text[begin : rest.match(text, end).end()], end - begin
        begin = end


def _runs(batches: Iterable[pa.RecordBatch], ahead: int, limit: int) -> Iterator[tuple[list[bytes], list[int], list[str]]]:
    """Segments of about ``limit`` bytes together, with the bytes that begin windows, and languages."""
    parts, own, langs, held = [], [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            value = text.as_py()
            if not value:
                continue
            data = value.encode("utf-8", "replace").lower()  # bytes: only A-Z
            for part, begins in _segments(data, ahead, limit):
                parts.append(part)
                own.append(begins)
                langs.append(lang.as_py())
                held += len(part)
                if held >= limit:
                    yield parts, own, langs
                    parts, own, langs, held = [], [], [], 0
    if parts:
        yield parts, own, langs


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _windows(parts: list[bytes], own: list[int], n: int):
    """Words of the parts; for each its text, whether it begins a window, and how many words of its
    piece follow, up to ``n - 1``."""
    words = words_of(parts, _CLASSES)
    raw = np.frombuffer(words.data, np.uint8)
    piece = np.cumsum(_IS_BREAK[raw])[words.starts]
    of = np.repeat(np.arange(len(parts)), np.diff(words.first))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    text_begins = np.cumsum(sizes) - sizes
    begins = words.starts - text_begins[of] < np.array(own)[of]
    follow = np.zeros(len(piece), np.int8)
    for k in range(1, n):
        same = np.zeros(len(piece), bool)
        same[: len(piece) - k] = piece[k:] == piece[: len(piece) - k]
        follow += same
    return words, of, begins, follow


def _phrase_buckets(words, of: np.ndarray, langs: list[str], n: int) -> Iterator[np.ndarray]:
    """For 2 to ``n`` words, the bucket of the phrase that begins at each word, in its language; what
    lies beyond the end of a piece is for the caller to leave out."""
    with np.errstate(over="ignore"):
        held = mix(words.hashes * _ODD + np.array([_lang_hash(v) for v in langs], np.uint64)[of])
        for k in range(1, n):
            held = mix(held * _ODD + np.roll(words.hashes, -k))
            yield (held >> np.uint64(64 - BUCKET_BITS)).astype(np.uint32)


def _add_up(buckets: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket once, in order, with its sum; sums stop at 255."""
    order = np.argsort(buckets, kind="stable")
    buckets = buckets[order]
    starts = np.flatnonzero(np.diff(buckets, prepend=np.uint32(0) if not len(buckets) else ~buckets[:1]))
    sums = np.add.reduceat(times[order].astype(np.uint32), starts) if len(starts) else np.zeros(0, np.uint32)
    return buckets[starts], np.minimum(sums, 255).astype(np.uint8)


def _is_set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)


def _texts(df: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )


def frequent_buckets(given: DataFrame, n: int, least: int) -> np.ndarray:
    """One bit for each bucket in which phrases of 2 to ``n`` words occur at least ``least`` times, all
    together, or at least 255 times."""
    span, enough = 1 << RANGE_BITS, min(least, 255)

    def emit(buckets: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        number = buckets >> np.uint32(RANGE_BITS)
        starts = np.flatnonzero(np.diff(number, prepend=~number[:1]))
        ends = np.append(starts[1:], len(number))
        places = buckets & np.uint32(span - 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(number[starts].astype(np.int32)),
                pa.array([places[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
                pa.array([times[s:e].tobytes() for s, e in zip(starts, ends, strict=True)], pa.binary()),
            ],
            ["part", "places", "times"],
        )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, times = np.zeros(0, np.uint32), np.zeros(0, np.uint8)
        for parts, own, langs in _runs(batches, n - 1, SEGMENT):
            words, of, begins, follow = _windows(parts, own, n)
            found = [b[begins & (follow >= k)] for k, b in enumerate(_phrase_buckets(words, of, langs, n), 1)]
            fresh = np.concatenate([buckets[:0], *found])
            fresh = _add_up(fresh, np.ones(len(fresh), np.uint8))
            buckets, times = _add_up(np.concatenate([buckets, fresh[0]]), np.concatenate([times, fresh[1]]))
            if len(buckets) >= COUNTED:
                yield from emit(buckets, times)
                buckets, times = buckets[:0], times[:0]
        if len(buckets):
            yield from emit(buckets, times)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, places, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = sums.setdefault(number, np.zeros(span, np.uint8))
                at = np.frombuffer(places, np.uint32)
                more = held[at] + np.frombuffer(times, np.uint8).astype(np.uint16)
                held[at] = np.minimum(more, enough)
        for number, held in sums.items():
            bits = np.packbits(held >= enough).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([bits], pa.binary())], ["part", "bits"])

    rows = given.mapInArrow(count, "part int, places binary, times binary").repartition(1 << (BUCKET_BITS - RANGE_BITS), "part")
    bits = np.zeros((1 << BUCKET_BITS) // 8, np.uint8)
    for r in rows.mapInArrow(add, "part int, bits binary").collect():  # at most 32 MB
        bits[r["part"] * span // 8 : (r["part"] + 1) * span // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def lead_windows(given: DataFrame, n: int, frequent: np.ndarray) -> DataFrame:
    """``lang, w1 .. wn, times``: windows of ``n`` words, null where they are padded, counted within
    runs of texts."""
    held = given.sparkSession.sparkContext.broadcast(frequent)
    names = [f"w{k + 1}" for k in range(n)]

    def counted(runs: list, lang_of: dict[str, int], spelled: list[str | None]) -> Iterator[pa.RecordBatch]:
        """Windows held so far: a row of word codes by place (0: padded), and below the code of the language."""
        keys = np.concatenate(runs, 1)
        one = np.zeros(keys.shape[1], np.uint64)
        with np.errstate(over="ignore"):
            for row in keys:
                one = mix(one * _ODD + row.astype(np.uint64))
        order = np.argsort(one, kind="stable")
        one = one[order]
        starts = np.flatnonzero(np.diff(one, prepend=~one[:1]))
        times = np.diff(np.append(starts, len(one)))
        keys = keys[:, order[starts]]
        strings, langs = pa.array(spelled, pa.string()), pa.array(list(lang_of), pa.string())
        for begin in range(0, len(times), 50_000):
            *places, codes = keys[:, begin : begin + 50_000]
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(codes)), *(strings.take(pa.array(p)) for p in places), pa.array(times[begin : begin + 50_000])],
                ["lang", *names, "times"],
            )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        runs, lang_of, number = [], {}, 0
        code_of, spelled = {}, [None]  # words of these runs by their number; none is 0, the padding
        for parts, own, langs in _runs(batches, n - 1, SEGMENT):
            words, of, begins, follow = _windows(parts, own, n)
            found, at, place = np.unique(words.hashes, return_index=True, return_inverse=True)
            for value, first in zip(found.tolist(), at.tolist(), strict=True):
                if value not in code_of:
                    code_of[value] = len(spelled)
                    spelled.append(words.text(first))
            codes = np.array([code_of[value] for value in found.tolist()], np.int32)[place]
            keys = np.zeros((n + 1, len(codes)), np.int32)
            keys[0] = codes
            going = np.ones(len(codes), bool)
            for k, buckets in enumerate(_phrase_buckets(words, of, langs, n), 1):
                going &= follow >= k
                going[going] = _is_set(bits, buckets[going])
                keys[k, going] = np.roll(codes, -k)[going]
            keys[n] = np.array([lang_of.setdefault(v, len(lang_of)) for v in langs], np.int32)[of]
            runs.append(keys[:, begins])
            number += int(begins.sum())
            if number >= WINDOWS:
                yield from counted(runs, lang_of, spelled)
                runs, lang_of, number = [], {}, 0
                code_of, spelled = {}, [None]
        if runs:
            yield from counted(runs, lang_of, spelled)

    columns = ", ".join(f"{name} string" for name in names)
    return given.mapInArrow(count, f"lang string, {columns}, times long")


def phrase_counts(windows: DataFrame, n: int, least: int) -> DataFrame:
    """``lang, phrase, words, f`` of phrases of up to ``n`` words with ``f >= least``, and with
    ``words = 0`` the number of words of each language: sums of the windows over ever shorter
    prefixes. Padded prefixes are the shorter windows themselves and are left out."""
    names = [f"w{k + 1}" for k in range(n)]
    # a padded place is told from a summed one by the level
    level = F.grouping_id()
    longest = windows.groupBy("lang", *names).agg(F.sum("times").alias("times"))
    summed = longest.rollup("lang", *names).agg(F.sum("times").alias("f"), level.alias("_level"))
    words: Column = F.lit(None).cast("int")
    for k in range(n + 1):
        full = F.col(names[k - 1]).isNotNull() if k else F.lit(True)
        words = F.when((F.col("_level") == (1 << (n - k)) - 1) & full, k).otherwise(words)
    return (
        summed.withColumn("words", words)
        .where((F.col("words") == 0) | (F.col("words").isNotNull() & (F.col("f") >= least)))
        .select("lang", F.when(F.col("words") == 0, "").otherwise(F.concat_ws(" ", *names)).alias("phrase"), "words", "f")
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def collocations(
    df: DataFrame, most_words: int = MOST_WORDS, least: int = LEAST, top: int = TOP, inside: int = INSIDE,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Candidates have two to ``most_words`` words and occur ``a >= least`` times. The score is that of
    the worst cut into two parts, of frequencies ``l`` and ``r``; ties go to the earlier cut. A
    candidate that lies in a longer one with at least ``inside`` percent of its frequency is dropped.
    Order: score, frequency, phrase by its bytes. Null and empty texts have no words, a null language
    is ``und``; repeated rows count each time; an empty table has no rows.
    """
    given = _texts(df, lang_col, text_col)
    windows = lead_windows(given, most_words, frequent_buckets(given, most_words, least))
    counts = freeze(phrase_counts(windows, most_words, least), "phrases")
    candidates = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("_w"))

    def part(begin: int | Column, length: int | Column) -> Column:
        return F.array_join(F.slice("_w", begin, length), " ")

    cuts = F.sequence(F.lit(1), F.col("words") - 1)
    asked = F.flatten(
        F.transform(
            cuts,
            lambda k: F.array(
                F.struct(part(1, k).alias("part"), k.alias("k"), F.lit(True).alias("left")),
                F.struct(part(k + 1, F.col("words") - k).alias("part"), k.alias("k"), F.lit(False).alias("left")),
            ),
        )
    )
    requests = candidates.select("lang", "phrase", "a", F.inline(asked)).withColumnRenamed("part", "_part")
    answers = counts.where("words between 1 and %d" % (most_words - 1)).select("lang", F.col("phrase").alias("_part"), "f")
    met = skew_join(requests, answers, ["lang", "_part"], "inner")
    # a phrase of m words lies in each longer candidate at most once a place
    lengths = F.sequence(F.lit(2), F.col("words") - 1)
    within = F.flatten(
        F.transform(lengths, lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda b: part(b, m)))
    )
    longer = candidates.where("words > 2").select("lang", F.explode(within).alias("phrase"), F.col("a").alias("longer"))
    pieces = [
        F.max(F.when((F.col("k") == k) & (F.col("left") == left), F.col("f"))).alias(f"_{side}{k}")
        for k in range(1, most_words)
        for side, left in (("l", True), ("r", False))
    ]
    together = (
        met.select("lang", "phrase", "a", "k", "left", "f", F.lit(None).cast("long").alias("longer"))
        .unionByName(longer, allowMissingColumns=True)
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("a"), F.max("longer").alias("_longer"), *pieces)
        .where(F.col("_longer").isNull() | (100 * F.col("_longer") < inside * F.col("a")))
    )
    scored = [
        F.when(F.col(f"_l{k}").isNotNull(), F.struct(
            _score(F.col("a"), F.col(f"_l{k}"), F.col(f"_r{k}")).alias("score"), F.lit(k).alias("k"),
            F.col(f"_l{k}").alias("l"), F.col(f"_r{k}").alias("r"),
        ))
        for k in range(1, most_words)
    ]
    worst = scored[0] if len(scored) == 1 else F.least(*scored)
    judged = together.withColumn("_cut", worst).select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    # the best of each share of a language first, so that the last step gets a bounded number of rows
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    for by in (("lang", share), ("lang",)):
        order = W.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        judged = judged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    best = judged
    totals = F.broadcast(counts.where("words = 0").select("lang", F.col("f").alias("n")))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


OP11_SQL = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, row_number() OVER () AS doc,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT lang, doc, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
split AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (
  SELECT lang, 1 AS m, w[i] AS phrase FROM places
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM places WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 2 <= len(w)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.a, k, l.f AS l, r.f AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM candidates AS c CROSS JOIN (SELECT unnest([1, 2]) AS k) AS ks
  JOIN f AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ')
  JOIN f AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 : c.m], ' ')
  WHERE k < c.m),
worst AS (
  SELECT lang, phrase, a, l, r, score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
holders AS (
  SELECT lang, array_to_string(w[b : b + 1], ' ') AS phrase, max(a) AS longer
  FROM candidates CROSS JOIN (SELECT unnest([1, 2]) AS b) AS bs WHERE m = 3 GROUP BY ALL),
kept AS (
  SELECT worst.* FROM worst LEFT JOIN holders USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN total USING (lang) WHERE rank <= 2000
"""
