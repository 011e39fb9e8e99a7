"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.session import freeze

CHUNK_CHARS = 500_000
BROADCAST_IDS = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names; a missing text is empty."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def chunks(sizes: Sequence[int], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts whose sizes add up to about ``limit``; one text is never cut."""
    begin = total = 0
    for k, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield begin, k + 1
            begin, total = k + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def row_chunks(
    batches: Iterable[pa.RecordBatch], at: int, limit: int = CHUNK_CHARS
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts, in column number ``at``, add up to a bounded size."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        for begin, end in chunks(sizes, limit):
            yield batch.slice(begin, end - begin)


def text_chunks(
    batches: Iterable[pa.RecordBatch], limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.Array, list[str], pa.RecordBatch]]:
    """Ids, texts and the slice of the batch for runs of rows of bounded text size.

    Only the texts of one run at a time become Python strings.
    """
    for batch in batches:
        for part in row_chunks([batch], batch.schema.get_field_index("text"), limit):
            yield part.column("doc_id"), part.column("text").to_pylist(), part


def _written_ids(ids: DataFrame, most: int) -> DataFrame:
    """``ids`` (one column ``doc_id``) written and counted once; up to ``most`` are broadcast, more
    meet other rows by a shuffle."""
    found = freeze(ids.select(F.col("doc_id").alias("_id")), "ids")
    return F.broadcast(found) if found.count() <= most else found


def without_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id", most: int = BROADCAST_IDS) -> DataFrame:
    """The rows, with all their columns, whose id is not in ``ids``."""
    return df.join(_written_ids(ids, most), F.col(id_col).cast("long") == F.col("_id"), "left_anti")


def with_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id", most: int = BROADCAST_IDS) -> DataFrame:
    """The rows, with all their columns, whose id is in ``ids``."""
    return df.join(_written_ids(ids, most), F.col(id_col).cast("long") == F.col("_id"), "left_semi")
