"""The jobs users run, put together from the operators."""

from regulink.plans.labels import build_biofeature_map
from regulink.plans.links import (
    build_capture_links,
    build_correlation_links,
    build_enhancer_links,
    build_gene_list_links,
    gene_tss,
)
from regulink.plans.quality import coverage_check, distance_check, nearest_check
from regulink.plans.qtl import build_qtl, write_qtl
from regulink.plans.scores import (
    fit_evidence_grids,
    prepare_evidence,
    prepare_slice,
    score_v1,
    score_v2,
    write_scores,
)

__all__ = [
    "build_biofeature_map",
    "build_capture_links",
    "build_correlation_links",
    "build_enhancer_links",
    "build_gene_list_links",
    "build_qtl",
    "coverage_check",
    "distance_check",
    "fit_evidence_grids",
    "gene_tss",
    "nearest_check",
    "prepare_evidence",
    "prepare_slice",
    "score_v1",
    "score_v2",
    "write_qtl",
    "write_scores",
]
