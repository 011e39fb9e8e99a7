"""Quality checks run on the results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from regulink.operators.checks import (
    concordance_summary,
    coverage_summary,
    describe_distance,
    distance_histogram,
    gene_coverage,
    nearest_concordance,
    parse_vep_nearest,
)
from regulink.operators.genes import link_distances
from regulink.session import freeze


def nearest_check(variants: DataFrame, annotated: DataFrame, **options) -> DataFrame:
    """How many variants have another nearest gene than an annotator says."""
    return concordance_summary(nearest_concordance(variants, parse_vep_nearest(annotated), **options))


def coverage_check(genes: DataFrame, **lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Protein-coding genes with a flag per list, and the totals."""
    covered = gene_coverage(genes, **lists)
    return covered, coverage_summary(covered, *lists)


def distance_check(
    links: DataFrame, genes: DataFrame, bins: int = 1000, chrom: str = "chr", anchor: str = "tss"
) -> tuple[DataFrame, DataFrame]:
    """Summary and histogram of link-gene distances, for choosing a threshold.

    Links are joined with their genes once, for both; only the columns that takes are written.
    """
    placed = links.select("chrom", "start", "end", "gene_id")
    distances = freeze(link_distances(placed, genes, chrom, anchor).select("delta"), "distances")
    return describe_distance(distances), distance_histogram(distances, bins)
