"""The two versions of the variant-gene score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink.fixed_values import QTL_TYPES
from regulink.operators.intervals import require
from regulink.operators.scoring import (
    FEATURE_KEYS,
    apply_quantile_grids,
    evidence_score,
    feature_aggregate,
    fit_quantile_grids,
    melt_scores,
    minmax,
    per_source_scores,
    quantile_scale,
    variant_gene_scores,
    wipe_consequence_feature,
)
from regulink.sources.writers import write_tsv


def prepare_evidence(
    evidence: DataFrame,
    consequence_weights: DataFrame,
    n_quantiles: int,
    by: Sequence[str] = FEATURE_KEYS,
    qtl_types: Sequence[str] = tuple(QTL_TYPES),
) -> DataFrame:
    """Evidence with its score and the score's position in its (source, feature)."""
    scored = evidence_score(evidence, consequence_weights, qtl_types)
    return quantile_scale(require(wipe_consequence_feature(scored), "score"), n_quantiles, by)


def fit_evidence_grids(
    evidence: DataFrame,
    consequence_weights: DataFrame,
    n_quantiles: int,
    by: Sequence[str] = FEATURE_KEYS,
    qtl_types: Sequence[str] = tuple(QTL_TYPES),
) -> DataFrame:
    """Quantile grids of all evidence, for :func:`~regulink.sources.write_grids`."""
    scored = evidence_score(evidence, consequence_weights, qtl_types)
    return fit_quantile_grids(wipe_consequence_feature(scored), n_quantiles, by)


def prepare_slice(
    evidence: DataFrame,
    consequence_weights: DataFrame,
    grids: DataFrame,
    by: Sequence[str] = FEATURE_KEYS,
    qtl_types: Sequence[str] = tuple(QTL_TYPES),
) -> DataFrame:
    """What :func:`prepare_evidence` gives, for a slice of the evidence and known grids; the slice is
    read once."""
    scored = evidence_score(evidence, consequence_weights, qtl_types)
    return apply_quantile_grids(require(wipe_consequence_feature(scored), "score"), grids, by)


def score_v2(
    evidence: DataFrame,
    consequence_weights: DataFrame,
    source_weights: Mapping[str, float] | None = None,
    by: Sequence[str] = FEATURE_KEYS,
    qtl_types: Sequence[str] = tuple(QTL_TYPES),
) -> dict[str, DataFrame]:
    """Best decile position per source, averaged over sources."""
    prepared = prepare_evidence(evidence, consequence_weights, 10, by, qtl_types)
    per_source = melt_scores(per_source_scores(prepared), ["ft_max"], "score")
    return {
        "preprocessed": prepared,
        "per_source_scores": per_source,
        "per_variant_scores": variant_gene_scores(per_source, source_weights),
    }


def score_v1(
    evidence: DataFrame,
    consequence_weights: DataFrame,
    feature_weights: Mapping[str, Mapping[str, float]] | None = None,
    source_weights: Mapping[str, float] | None = None,
    by: Sequence[str] = FEATURE_KEYS,
    qtl_types: Sequence[str] = tuple(QTL_TYPES),
) -> dict[str, DataFrame]:
    """Best percentile position and scaled feature count per source, then a mean over sources."""
    prepared = prepare_evidence(evidence, consequence_weights, 100, by, qtl_types)
    counted = minmax(per_source_scores(prepared, counts=True), one_row_per_gene=True)
    per_source = melt_scores(counted, ["ft_max", "ft_count_scaled"])
    aggregated = feature_aggregate(per_source, feature_weights)
    return {
        "preprocessed": prepared,
        "per_source_scores": per_source,
        "per_source_aggregate_scores": aggregated,
        "per_variant_aggregate_scores": variant_gene_scores(aggregated, source_weights, "ft_agg"),
    }


def write_scores(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write each table as TSV in a folder of its name, arrays as JSON text."""
    for name, table in tables.items():
        lists = [f.name for f in table.schema.fields if f.dataType.typeName() == "array"]
        plain = table.withColumns({c: F.to_json(c) for c in lists})
        write_tsv(plain, f"{path.rstrip('/')}/{name}")
