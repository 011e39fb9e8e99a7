"""Nearest vectors by inner product with an inverted multi-index.

The two halves of a vector are quantised separately; a pair of centroids is a cell, and every row
lies in one. A query walks over the cells by falling sum of its inner products with both centroids,
by a heap, until it has passed as many rows as the measured recall asks for, and the rows of these
cells are ranked by their exact inner product.

The cells of one first centroid are compared in blocks: entries and visits are both cut into parts
of bounded size, so neither a large cell nor one that every query visits is one task.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regulink.llm.common import table
from regulink.llm.vectors import binaries, dense, dimension, vectors
from regulink.operators.joins import salt_of
from regulink.session import freeze

NEIGHBOURS = 20
SAMPLE_ROWS = 20_000  # vectors that centroids are fitted on
CELL_ROWS = 16  # rows in a cell, on average
MOST_CENTROIDS = 1024  # of a half, so that the sizes of all cells are 8 MB at most
STEPS = 10  # of k-means
TRIAL_QUERIES = 256  # compared with every row to set how far queries walk
RECALL = 0.96  # of the trial queries
ENTRIES = VISITS = 8192  # rows and queries of a block
SLICE = 512  # queries that are compared at a time


@dataclass
class MultiIndex:
    """``half`` entries of a vector belong to the first centroids; a cell is
    ``first * len(second) + second``; a query passes ``walk`` rows."""

    dim: int
    rows: int
    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray
    walk: int

    @property
    def half(self) -> int:
        return self.first.shape[1]


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """``row, vec_id, vector`` of the rows that take part, and the length of the vectors.

    A row takes part if it has an id and a vector of the commonest length that is not zero and holds
    neither null nor non-finite entries. ``row`` is a number of its own, also for rows that repeat.
    """
    given = vectors(df, id_col, vec_col)
    d, kind = dimension(given), given.schema["vector"].dataType.simpleString()
    plain = pa.float32() if kind == "array<float>" else pa.float64()

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, matrix = dense(batch.column(1), d)
            there = (matrix != 0).any(axis=1)
            rows, matrix = rows[there], matrix[there]
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), _lists(matrix, plain)], ["vec_id", "vector"]
                )

    there = given.where("vec_id is not null and size(vector) > 0")
    found = there.mapInArrow(keep, f"vec_id long, vector {kind}")
    return freeze(found.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector"), "vectors"), d


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()).cast(kind))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(np.float64)


def _type_of(rows: DataFrame) -> str:
    return rows.schema["vector"].dataType.simpleString()


def _sample(rows: DataFrame, count: int, most: int, seed: int) -> np.ndarray:
    """At most ``most`` vectors, taken by a hash of the row."""
    place = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(1 << 30))
    share = min(1.0, 2 * most / max(count, 1))
    taken = rows.where(place <= math.ceil(share * (1 << 30))).orderBy(place, "row").limit(most)
    return np.array([r["vector"] for r in taken.select("vector").toArrow().to_pylist()], dtype=float)


def centroids(points: np.ndarray, k: int, seed: int, steps: int = STEPS) -> np.ndarray:
    """Lloyd's k-means from ``k`` different points; a centroid without points stays where it is."""
    different = np.unique(points, axis=0)
    found = different[np.random.default_rng(seed).permutation(len(different))[:k]]
    for _ in range(steps):
        nearest = _assign(points, found)
        counts = np.bincount(nearest, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, points)
        there = counts > 0
        found[there] = sums[there] / counts[there, None]
    return found


def _assign(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centroid of each point."""
    norms = (centres**2).sum(axis=1)
    nearest = [np.argmin(norms - 2 * points[at : at + 4096] @ centres.T, axis=1) for at in range(0, len(points), 4096)]
    return np.concatenate([*nearest, np.zeros(0, np.int64)])


def _cells(matrix: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    half = first.shape[1]
    return _assign(matrix[:, :half], first) * len(second) + _assign(matrix[:, half:], second)


def walk_cells(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, walk: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells a query visits: first centroids, and for each a row that marks second centroids.

    ``one`` and ``two`` are its inner products with the centroids. The heap holds for each opened
    first centroid its next cell, so cells come out by falling sum; the walk ends when ``walk`` rows
    were passed, or all.
    """
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    x, y = (-one[a]).tolist(), (-two[b]).tolist()
    grid = sizes.reshape(len(one), len(two))
    lines: list[list[int]] = [grid[a[0]][b].tolist()]
    reached = [0] * len(x)
    heap = [(x[0] + y[0], 0, 0)]
    passed = 0
    while heap:
        _, i, j = heap[0]
        passed += lines[i][j]
        reached[i] = j + 1
        if passed >= walk:
            break
        if j + 1 < len(y):
            heapq.heapreplace(heap, (x[i] + y[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(x):
            lines.append(grid[a[i + 1]][b].tolist())
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    place = np.empty(len(b), np.int64)
    place[b] = np.arange(len(b))
    some = np.flatnonzero(reached)
    return a[some], place[None, :] < np.array(reached)[some, None]


def _scores(queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up from the first entry on, so that equal vectors have
    equal scores wherever they are."""
    total = np.zeros(len(queries))
    for q, e in zip(queries.T, entries.T, strict=True):
        total += q * e
    return total


def _best(
    queries: np.ndarray, own: np.ndarray, entries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int,
    allowed: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query and entry numbers and scores of each query's ``k`` best of the entries, ties to the
    smaller id; never its own row, and only entries that are allowed."""
    rough = queries @ entries.T
    rough[own[:, None] == rows[None, :]] = -np.inf
    if allowed is not None:
        rough[~allowed] = -np.inf
    last = np.full(len(queries), -np.inf)
    if len(rows) > k:
        last = np.partition(rough, len(rows) - k, axis=1)[:, len(rows) - k]
    # products in another order differ in the last bits only
    slack = 1e-9 * np.linalg.norm(queries, axis=1) * np.linalg.norm(entries, axis=1).max()
    q, e = np.nonzero((rough >= (last - slack)[:, None]) & (rough > -np.inf))
    exact = np.concatenate(
        [*(_scores(queries[q[at : at + 65536]], entries[e[at : at + 65536]]) for at in range(0, len(q), 65536)), np.zeros(0)]
    )
    order = np.lexsort((rows[e], ids[e], -exact, q))
    q, e, exact = q[order], e[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], e[place < k], exact[place < k]


def _trial(rows: DataFrame, queries: DataFrame, d: int, first: np.ndarray, second: np.ndarray, sizes: np.ndarray, k: int) -> int:
    """How many rows a query has to pass for a recall of ``RECALL``, from bounded trial queries that
    are compared with every row."""
    place = F.xxhash64(F.lit(3), "row")
    trial = queries.orderBy(place, "row").limit(TRIAL_QUERIES).select("row", "vector").toArrow()
    if not trial.num_rows:
        return 0
    own = np.array(trial.column("row").to_pylist())
    asked = np.array(trial.column("vector").to_pylist(), dtype=float)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ENTRIES):
                part = batch.slice(begin, ENTRIES)
                matrix = _matrix(part.column(2), d)
                ids = part.column(1).to_numpy()
                q, e, score = _best(asked, own, matrix, part.column(0).to_numpy(), ids, k)
                cells = _cells(matrix, first, second)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(ids[e]), pa.array(score), pa.array(cells[e])], ["q", "vec_id", "score", "cell"]
                )

    near = rows.mapInArrow(compare, "q long, vec_id long, score double, cell long")
    order = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    true = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("q", "cell").collect()
    half, needed = first.shape[1], []
    by_query: dict[int, list[int]] = {}
    for r in true:
        by_query.setdefault(r["q"], []).append(r["cell"])
    for q, cells in by_query.items():
        summed = (first @ asked[q, :half])[:, None] + (second @ asked[q, half:])[None, :]
        order_of = np.argsort(-summed.ravel(), kind="stable")
        passed = np.empty(len(order_of), np.int64)
        passed[order_of] = np.cumsum(sizes[order_of])
        needed.extend(passed[cells].tolist())
    needed.sort()
    return needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))] if needed else 0


def build_index(rows: DataFrame, queries: DataFrame, d: int, k: int = NEIGHBOURS) -> tuple[MultiIndex, DataFrame]:
    """The index and every row with its cell (``row, vec_id, vector, cell``).

    Centroids are fitted on at most ``SAMPLE_ROWS`` vectors taken by a hash; all rows are indexed.
    """
    count = rows.count()
    number = max(1, min(MOST_CENTROIDS, math.ceil(math.sqrt(count / CELL_ROWS))))
    sample = _sample(rows, count, SAMPLE_ROWS, 1).reshape(-1, d)
    half = d // 2
    first, second = centroids(sample[:, :half], number, 1), centroids(sample[:, half:], number, 2)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _cells(_matrix(batch.column(2), d), first, second)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], ["row", "vec_id", "vector", "cell"])

    placed = freeze(rows.mapInArrow(place, f"row long, vec_id long, vector {_type_of(rows)}, cell long"), "cells")
    sizes = np.zeros(len(first) * len(second), np.int64)
    for r in placed.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2 numbers
        sizes[r["cell"]] = r["count"]
    walk = _trial(rows, queries, d, first, second, sizes, k)
    return MultiIndex(d, count, first, second, sizes, max(walk, k + 1)), placed


def search(index: MultiIndex, placed: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows that each query (``row, vec_id,
    vector``) finds, its own row left out; ties go to the smaller id."""
    d, half, width = index.dim, index.half, len(index.second)
    first, second, sizes, walk = index.first, index.second, index.sizes, index.walk

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = _matrix(batch.column(2), d)
            for begin in range(0, len(asked), 256):
                some = asked[begin : begin + 256]
                ones, twos = some[:, :half] @ first.T, some[:, half:] @ second.T
                found = [walk_cells(ones[at], twos[at], sizes, walk) for at in range(len(some))]
                at = pa.array(np.repeat(np.arange(begin, begin + len(some)), [len(g) for g, _ in found]))
                groups = np.concatenate([g for g, _ in found]).astype(np.int32)
                marks = np.packbits(np.concatenate([seen for _, seen in found]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(at) for c in batch.columns), pa.array(groups),
                     binaries(marks.tobytes(), np.full(len(marks), marks.shape[1]))],
                    ["row", "vec_id", "vector", "group", "seen"],
                )

    visits = queries.select("row", "vec_id", "vector").mapInArrow(
        visit, f"row long, vec_id long, vector {_type_of(queries)}, group int, seen binary"
    )
    visits = freeze(visits, "visits")
    in_group = sizes.reshape(len(first), width).sum(axis=1)
    asked = {r["group"]: r["count"] for r in visits.groupBy("group").count().collect()}  # one number a centroid
    entry_parts = np.ceil(in_group / ENTRIES).astype(int)
    visit_parts = np.array([math.ceil(asked.get(g, 0) / VISITS) for g in range(len(first))])

    def parts_of(numbers: np.ndarray):
        return F.get(F.array(*[F.lit(int(v)) for v in numbers]), F.col("group"))

    def dealt(df: DataFrame, own: np.ndarray, other: np.ndarray, mine: str, theirs: str) -> DataFrame:
        """Rows dealt to one of their own parts, and to each part of the other side."""
        return (
            df.where((parts_of(own) > 0) & (parts_of(other) > 0))
            .withColumn(mine, F.pmod(salt_of(["row"], 1 << 30), parts_of(own)))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), parts_of(other) - 1)))
        )

    grouped = placed.withColumn("group", F.expr(f"cast(cell div {width} as int)"))
    left = dealt(grouped, entry_parts, visit_parts, "part", "turn").groupBy("group", "part", "turn")
    right = dealt(visits, visit_parts, entry_parts, "turn", "part").groupBy("group", "part", "turn")

    def rank(entries: pa.Table, visiting: pa.Table) -> pa.Table:
        empty = {"row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not entries.num_rows or not visiting.num_rows:
            return pa.table(empty)
        entries, visiting = entries.combine_chunks(), visiting.combine_chunks()
        matrix = _matrix(entries.column("vector").combine_chunks(), d)
        seconds = entries.column("cell").to_numpy() % width
        rows, ids = entries.column("row").to_numpy(), entries.column("vec_id").to_numpy()
        parts = []
        for begin in range(0, visiting.num_rows, SLICE):
            some = visiting.slice(begin, SLICE).combine_chunks()
            marks = np.frombuffer(b"".join(some.column("seen").to_pylist()), np.uint8).reshape(some.num_rows, -1)
            allowed = np.unpackbits(marks, axis=1, count=width)[:, seconds].astype(bool)
            queries = _matrix(some.column("vector").combine_chunks(), d)
            q, e, score = _best(queries, some.column("row").to_numpy(), matrix, rows, ids, k, allowed)
            parts.append(
                pa.table(
                    {
                        "row": some.column("row").take(pa.array(q)), "query_id": some.column("vec_id").take(pa.array(q)),
                        "vec_id": pa.array(ids[e]), "score": pa.array(score),
                    }
                )
            )
        return pa.concat_tables(parts)

    near = left.cogroup(right).applyInArrow(rank, "row long, query_id long, vec_id long, score double")
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def nearest_vectors(
    df: DataFrame, every: int, k: int = NEIGHBOURS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for each row whose id is
    divisible by ``every``, by inner product in doubles, ties to the smaller id.

    Rows without an id or a usable vector (see :func:`usable`) take no part. Rows that repeat an id
    are queries and candidates of their own. An empty table has no rows.
    """
    rows, d = usable(df, id_col, vec_col)
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    if not d or queries.isEmpty():
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, placed = build_index(rows, queries, d, k)
    return search(index, placed, queries, k)


def op13_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_vectors(table(spark, folder, "embeddings"), every=20)
