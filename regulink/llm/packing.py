"""Best-fit packing: few-document length patterns fitted to the histogram, residuals best-fit."""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regulink.llm.common import table, text_chunks, texts
from regulink.llm.wordhash import classes_of, words_of
from regulink.session import freeze

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
PARTNERS = 32  # partners tried for each length when patterns of three are enumerated
ROUNDS = 300  # steps of the non-negative fit
BUCKET_ROWS, MAX_BUCKETS = 500, 200_000
KNOWN_MAX = 350_000  # pre-tokens whose ids a worker remembers

# ASCII, and Latin letters with marks.
_SIMPLE = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
_HARD = re.compile(r"'|<\|")  # apostrophes start pre-tokens of their own, added tokens start like the other
_CLASSES = classes_of(b" \t\n\r\x0b\x0c", digits=True, marks=True)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_characters() -> dict[int, str]:
    """Latin-1 characters to those by which the vocabulary writes their bytes."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class PreTokenIds:
    """Ids of texts as little-endian unsigned 32-bit numbers, encoded once for each pre-token.

    The tokenizer drops white space and joins nothing across pre-tokens. In texts of ``_SIMPLE``
    characters these are runs of letters or of marks, and single digits. Other texts, and those with
    an apostrophe or with what may be an added token, are encoded by the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.known: dict[int, bytes] = {}
        self.characters = byte_characters()

    def _ids(self, pre_token: str) -> bytes:
        written = pre_token.encode().decode("latin-1").translate(self.characters)
        ids = [t.id for t in self.model.tokenize(written)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _simple(self, values: list[str]) -> list[bytes]:
        words = words_of([v.lower().encode() for v in values], _CLASSES)
        codes, distinct = pd.factorize(words.hashes)
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        if len(self.known) > KNOWN_MAX:
            self.known.clear()
        said = [self.known.get(h) for h in distinct.tolist()]
        for k, ids in enumerate(said):
            if ids is None:
                said[k] = self.known[int(distinct[k])] = self._ids(words.text(first[k]))
        flat = np.frombuffer(b"".join(said), "<u4")
        sizes = np.fromiter(map(len, said), np.int64, len(said)) // 4
        begins = np.cumsum(sizes) - sizes
        mine = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(mine)])
        at = np.repeat(begins[codes] - ends[:-1], mine) + np.arange(ends[-1])
        bounds = 4 * ends[words.first]
        raw = flat[at].tobytes()
        return [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def encode(self, values: list[str]) -> list[bytes]:
        easy = [not _HARD.search(v) and (v.isascii() or _SIMPLE.fullmatch(v) is not None) for v in values]
        fast = iter(self._simple([v for v, e in zip(values, easy, strict=True) if e]))
        return [
            next(fast) if e else np.array(self.whole.encode(v, add_special_tokens=False).ids, "<u4").tobytes()
            for v, e in zip(values, easy, strict=True)
        ]


_loaded: dict[str, PreTokenIds] = {}  # by path, for the life of a Python worker


def token_pieces(
    df: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each row's ids and the end id, cut at ``capacity``.

    A null or empty text is the end id alone. Only documents longer than ``capacity`` are cut.
    """
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = PreTokenIds(path)
        for ids, values, _ in text_chunks(batches):
            rows = []
            for doc_id, raw in zip(ids.to_pylist(), _loaded[path].encode(values), strict=True):
                raw += end
                for k in range(0, len(raw), 4 * capacity):
                    piece = raw[k : k + 4 * capacity]
                    rows.append((doc_id, k // (4 * capacity), k // 4, len(piece) // 4, zlib.crc32(piece)))
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return texts(df, id_col, text_col).mapInArrow(cut, PIECES)


def enumerate_patterns(counts: np.ndarray, partners: int = PARTNERS) -> list[tuple[int, ...]]:
    """Patterns of one to four lengths that fill the capacity exactly; ``counts`` is by length."""
    capacity = len(counts) - 1
    there = np.flatnonzero(counts)
    found: set[tuple[int, ...]] = set()
    for n in range(1, 5):  # equal parts
        if capacity % n == 0 and counts[capacity // n]:
            found.add((capacity // n,) * n)
    common = there[np.argsort(-counts[there], kind="stable")]
    for a in there.tolist():
        rest = capacity - a
        if 0 < rest <= a and counts[rest]:
            found.add((a, rest))
        fits = common[(common < rest) & (common <= a)]
        fits = fits[counts[rest - fits] > 0][:partners]
        found.update(tuple(sorted((a, b, rest - b), reverse=True)) for b in fits.tolist())
        if rest > 0 and rest % 3 == 0 and counts[rest // 3]:
            found.add(tuple(sorted((a, *(rest // 3,) * 3), reverse=True)))
    return sorted(found, reverse=True)


def fit_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts of the patterns: non-negative least squares against the histogram."""
    width = max(map(len, patterns))
    parts = np.array([p + (0,) * (width - len(p)) for p in patterns])
    used = parts > 0
    goal = counts.astype(float)

    def made(x: np.ndarray) -> np.ndarray:
        return np.bincount(parts[used], np.broadcast_to(x[:, None], parts.shape)[used], len(counts))

    touched = made(np.ones(len(patterns)))
    # a step for each pattern that no sum of them can overshoot
    step = 1 / np.maximum((touched[parts] * used).sum(1), 1)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * ((made(y) - goal)[parts] * used).sum(1))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        x, y, t = new, new + (t - 1) / after * (new - x), after
    return x


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over the histogram: equal sequences are one pattern with its repeats."""
    capacity = len(counts) - 1
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_by_room[room].append((pattern, n))

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left and (at := bisect_left(rooms, length)) < len(rooms):
            room = rooms[at]
            pattern, n = open_by_room[room].pop()
            if n > left:
                open_by_room[room].append((pattern, n - left))
            elif not open_by_room[room]:
                del open_by_room[room], rooms[at]
            put(room - length, pattern + (length,), min(n, left))
            left -= min(n, left)
        each = capacity // length
        if left >= each:
            put(capacity - each * length, (length,) * each, left // each)
        if left % each:
            put(capacity - left % each * length, (length,) * (left % each), 1)
    return [one for room in rooms for one in open_by_room[room]]


def pack_histogram(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and repeats that use every counted length exactly once.

    ``counts[l]`` is the number of pieces of length ``l``. The fitted repeats are rounded down and
    taken as far as pieces are left; what remains is packed by best fit.
    """
    left = counts.astype(np.int64).copy()
    runs: list[tuple[tuple[int, ...], int]] = []
    if patterns := enumerate_patterns(left):
        repeats = np.floor(fit_repeats(patterns, left) + 1e-6).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            lengths, times = np.unique(patterns[k], return_counts=True)
            n = min(int(repeats[k]), int((left[lengths] // times).min()))
            if n > 0:
                left[lengths] -= n * times
                runs.append((patterns[k], n))
    return runs + best_fit(left)


def slots(runs: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``length, first rank, times, first sequence, first offset`` sorted by length and rank."""
    rows, next_rank, sequence = [], {}, 0
    for pattern, n in runs:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            times = pattern.count(length)
            rank = next_rank.get(length, 0)
            rows.append((length, rank, times, sequence, offset))
            next_rank[length] = rank + times * n
            offset += times * length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces with ``length`` 1 to ``capacity``.

    ``pieces`` has to give the same rows whenever it is read (a written table). The driver gets the
    histogram, of ``capacity`` numbers. Pieces of one length get ranks from 0: they are spread over
    buckets by a hash, the more the more there are, and bucket sizes are summed up. The slot table
    says which ranks of a length go to which sequences. An empty table gives no rows.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        counts[length] = n
    found = slots(pack_histogram(counts))
    spark = pieces.sparkSession
    buckets = [(k, min(-(-int(n) // BUCKET_ROWS), MAX_BUCKETS)) for k, n in enumerate(counts) if n]
    spread = spark.createDataFrame(buckets, "length long, _buckets long")
    salted = pieces.join(F.broadcast(spread), "length").withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start"), "_buckets")
    )
    sizes = salted.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    firsts = sizes.select(
        "length", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first")
    )
    within = W.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(
        firsts, ["length", "_bucket"]
    )
    ranked = ranked.select(*pieces.columns, (F.col("_first") + F.col("_rank")).alias("_rank"))
    table_of = spark.sparkContext.broadcast(found)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table_of.value
        keys = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            slot = rows[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            turn, place_of = np.divmod(rank - slot[:, 1], slot[:, 2])
            kept = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(slot[:, 3] + turn),
                    pa.array(slot[:, 4] + place_of * length),
                ],
                [*kept, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    df: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents with the sequence and the place in it that each takes.

    Repeated rows are packed as often as they occur. The pieces are written once in the shared
    scratch area, so ranks stay the same when executors are lost.
    """
    return pack(freeze(token_pieces(df, path, capacity, end_id, id_col, text_col), "pieces"), capacity)


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))
