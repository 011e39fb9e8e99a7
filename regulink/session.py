"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

# Runtime settings the plans in this library rely on; all can be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on adaptive execution and skew splitting for this session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The application's folder inside the cluster's shared checkpoint folder.

    Only a master of one process may fall back to a temporary folder of the machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="regulink-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_written: list[str] = []  # scratch paths handed out and not yet deleted


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared scratch area."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was written in the scratch area inside; results must be stored before."""
    begun = len(_written)
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for path in _written[begun:]:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        del _written[begun:]


def row_bytes(df: DataFrame) -> Column:
    """Rough in-memory size of a row."""
    total = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(16)
        elif isinstance(field.dataType, ArrayType):
            fields = getattr(field.dataType.elementType, "fields", [None])
            size = F.greatest(F.size(field.name), F.lit(0)) * F.lit(24 * len(fields)) + F.lit(16)
        else:
            size = F.lit(8)
        total = total + size
    return total


def sizes_of(df: DataFrame) -> tuple[int, int] | None:
    """Rows and rough bytes of a table that was measured when it was frozen."""
    return getattr(df, "_frozen_sizes", None)


def same_sizes(df: DataFrame, measured: DataFrame) -> DataFrame:
    """Let a table with the rows of a measured one, and no more bytes, count as measured too."""
    df._frozen_sizes = sizes_of(measured)
    return df


def freeze(df: DataFrame, label: str = "frozen", measured: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch area and return the written table.

    Cuts the lineage, so values that depend on where a row sat (partition number, row number)
    stay the same when executors are lost, and Catalyst then knows the table's real size.
    ``measured`` counts rows and bytes in the same pass, for :func:`sizes_of`.
    """
    path = scratch_path(df.sparkSession, label)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes")) if measured else df
    counted.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    if measured:
        written._frozen_sizes = (seen.get["rows"] or 0, seen.get["bytes"] or 0)
    return written
