"""Writers. All write from the executors; nothing is gathered on the driver."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink.operators.joins import salt_of
from regulink.session import freeze, sizes_of

INTERVAL_ORDER = ("chrom", "start", "end")
POSITION_ORDER = ("chrom", "pos")
QTL_PARTITIONS = ("type", "study_id", "bio_feature")
FILE_BYTES = 256 * 1024 * 1024
PACKED = 4  # bytes of a row in memory for one in a file
MANIFEST_FILES = 100_000  # files that one file of the manifest lists
_SPREAD = 1 << 16


def dataset_path(root: str, data_type: str, exp_type: str, source: str, version: str) -> str:
    """Where a data set of one source and version belongs."""
    return "/".join([root.rstrip("/"), data_type, exp_type, source, version, "data.parquet"])


def manifest_path(path: str) -> str:
    return path.rstrip("/") + ".manifest"


def range_sorted(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition by ``order`` and sort inside partitions.

    A salt follows the sort columns in the range, so rows equal in all of them can still be cut
    into several partitions.
    """
    columns = df.columns
    keys = [*order, "_salt"]
    salted = df.withColumn("_salt", salt_of(columns, _SPREAD))
    ranged = (
        salted.repartitionByRange(*keys)
        if partitions is None
        else salted.repartitionByRange(partitions, *keys)
    )
    return ranged.sortWithinPartitions(*keys).select(*columns)


def _sized(df: DataFrame, partitions: int | None, file_bytes: int = FILE_BYTES) -> tuple[DataFrame, int]:
    """The table and the number of files of about ``file_bytes`` it makes.

    Unless the number is given the table is measured: written once, if it was not yet, so that it is
    computed once for its size, for the sample that ranges are cut by, and for the files. The size is
    that of rows in memory, which is several times that of the compressed file.
    """
    if partitions is not None:
        return df, partitions
    if sizes_of(df) is None:
        df = freeze(df, "unsorted", measured=True)
    return df, max(1, math.ceil(sizes_of(df)[1] / (file_bytes * PACKED)))


def write_sorted(
    df: DataFrame,
    path: str,
    order: Sequence[str] = INTERVAL_ORDER,
    partitions: int | None = None,
) -> None:
    """Position-sorted Parquet, so that readers can skip row groups by position.

    The number of files follows the measured size unless it is given. Beside the files lies a
    manifest of the keys each holds, for :func:`~regulink.sources.read_region`.
    """
    df, number = _sized(df, partitions)
    range_sorted(df, order, number).write.parquet(path, mode="overwrite", compression="snappy")
    write_manifest(df.sparkSession, path, order)


def write_manifest(spark: SparkSession, path: str, order: Sequence[str] = INTERVAL_ORDER) -> None:
    """For each file and value of the first sort column: rows, the first and last place, and the
    farthest end of what starts there. Only the sort columns are read."""
    first, place, end = order[0], order[1], order[-1]
    rows = spark.read.parquet(path)
    if rows.isEmpty():
        return
    (
        rows.groupBy(F.col("_metadata.file_name").alias("file"), F.col(first).alias("part"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(place).cast("long").alias("first"),
            F.max(place).cast("long").alias("last"),
            F.max(F.greatest(place, end)).cast("long").alias("farthest"),
        )
        .repartitionByRange(1 + len(rows.inputFiles()) // MANIFEST_FILES, "part", "first")
        .sortWithinPartitions("part", "first")
        .write.parquet(manifest_path(path), mode="overwrite")
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    parts: Sequence[str] = QTL_PARTITIONS,
    order: Sequence[str] = POSITION_ORDER,
    partitions: int | None = None,
) -> None:
    """Parquet in one directory per value of ``parts``, position-sorted inside.

    The range starts with the directory columns, so a task writes few directories. Everything that
    was there before is replaced; to add a study see :func:`add_partitioned`.
    """
    df, number = _sized(df, partitions)
    range_sorted(df, [*parts, *order], number).write.partitionBy(*parts).parquet(
        path, mode="overwrite", compression="snappy"
    )


def add_partitioned(
    df: DataFrame,
    path: str,
    parts: Sequence[str] = QTL_PARTITIONS,
    order: Sequence[str] = POSITION_ORDER,
    partitions: int | None = None,
) -> None:
    """Add to a table of :func:`write_partitioned`, or start one.

    Only directories that ``df`` has rows for are replaced, as a whole and when all tasks are done;
    all others keep their files. So a job that fails changes nothing, and one that is run again gives
    the same rows. An empty ``df`` changes nothing.
    """
    df, number = _sized(df, partitions)
    (
        range_sorted(df, [*parts, *order], number)
        .write.partitionBy(*parts)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path, mode="overwrite", compression="snappy")
    )


def write_grids(grids: DataFrame, root: str, version: str) -> None:
    """Keep quantile grids as one version of the table at ``root``; a version is replaced as a whole."""
    if not version or "/" in version or "=" in version:
        raise ValueError("a version is a plain name")
    grids.withColumn("version", F.lit(version)).repartition(1, "version").write.partitionBy("version").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(root, mode="overwrite")


def write_tsv(df: DataFrame, path: str) -> None:
    """Headered, compressed TSV."""
    df.write.csv(path, mode="overwrite", sep="\t", header=True, compression="gzip")


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line; nulls are written out."""
    df.write.option("ignoreNullFields", "false").mode("overwrite").json(path)
