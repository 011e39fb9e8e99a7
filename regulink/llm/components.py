"""Connected components of links between documents."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink.session import freeze

ROWS_PER_FILE = 200_000


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``links`` (columns ``a, b``): the smallest node reachable.

    In a step every node takes the smallest label among its neighbours, then that label's own label,
    so chains shorten by half and the steps are few. Labels are written after every second step. It
    ends when the second of two changes nothing.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = freeze(both.where("a <> b").distinct(), "links")
    files = 1 + both.count() // ROWS_PER_FILE
    least = F.least(F.first("a"), F.min("b")).alias("component")
    labels = both.groupBy(F.col("a").alias("node")).agg(least)
    while True:
        once = _step(both, labels).select("node", "component").persist(StorageLevel.DISK_ONLY)
        after = freeze(_step(both, once).repartition(files), "labels")
        once.unpersist()
        labels = after.select("node", "component")
        if after.where("component <> _old").isEmpty():
            return labels


def _step(both: DataFrame, labels: DataFrame) -> DataFrame:
    near = (
        both.join(labels.select(F.col("node").alias("b"), "component"), "b")
        .groupBy(F.col("a").alias("node"))
        .agg(F.min("component").alias("_near"))
    )
    moved = labels.join(near, "node").select(
        "node", F.col("component").alias("_old"), F.least("component", "_near").alias("_new")
    )
    onward = labels.select(F.col("node").alias("_new"), F.col("component").alias("_next"))
    return moved.join(onward, "_new", "left").select(
        "node", F.least("_new", F.coalesce("_next", "_new")).alias("component"), "_old"
    )
