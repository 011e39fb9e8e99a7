"""QTL associations from summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from regulink.fixed_values import FAMILY_WISE_ALPHA
from regulink.operators.intervals import require
from regulink.operators.qtl import bonferroni, feature_list, standardise_qtl
from regulink.sources.writers import POSITION_ORDER, write_jsonl, write_partitioned, write_sorted


def build_qtl(
    sumstats: DataFrame, composite: bool = False, alpha: float = FAMILY_WISE_ALPHA
) -> DataFrame:
    """Significant associations with a gene, in output form."""
    return standardise_qtl(require(bonferroni(sumstats, alpha), "gene_id"), composite)


def write_qtl(
    sumstats: DataFrame,
    path: str,
    composite: bool = False,
    alpha: float = FAMILY_WISE_ALPHA,
    partitions: int | None = None,
) -> None:
    """Write the associations, and next to them the list of data sets they come from.

    The list is read from the written table, so the input is processed once. With ``composite`` one
    position-sorted table is written, otherwise one directory per type, study and biofeature.
    """
    associations = build_qtl(sumstats, composite, alpha)
    if composite:
        write_sorted(associations, path, POSITION_ORDER, partitions)
        columns = ["source", "feature"]
    else:
        write_partitioned(associations, path, partitions=partitions)
        columns = ["type", "study_id", "bio_feature"]
    written = sumstats.sparkSession.read.schema(associations.schema).parquet(path)
    write_jsonl(feature_list(written, columns), path.rstrip("/") + ".feature_list.json")
