"""Operators: functions from DataFrame to DataFrame."""

from regulink.operators.biofeatures import (
    concat_labels,
    filter_quant,
    label_table,
    lookup_biofeature,
    make_biofeature_labels,
    make_composites,
    map_biofeature,
    missing_labels,
    remap_biofeatures,
)
from regulink.operators.checks import (
    assert_no_nulls,
    concordance_summary,
    coverage_summary,
    describe_distance,
    distance_histogram,
    first_per_key,
    gene_coverage,
    nearest_concordance,
    null_report,
    parse_vep_nearest,
    slice_stats,
    split_variant_id,
)
from regulink.operators.evidence import (
    evidence_matrix,
    for_variant,
    for_variant_table,
    nested_answers,
    source_evidence,
    source_ranks,
    tissue_evidence,
    variant_evidence,
    variant_ranks,
)
from regulink.operators.genes import (
    add_gene_position,
    coding_genes,
    coding_transcripts,
    gene_midpoint,
    gene_name_map,
    gtf_features,
    link_distances,
    map_gene_names,
    map_symbols,
    map_symbols_from_gtf,
    official_names,
    strand_report,
    symbol_map_from_gtf,
    synonym_names,
    transcript_tss,
)
from regulink.operators.intervals import (
    add_distance,
    allowed_chroms,
    cis_only,
    explode_genes,
    filter_report,
    keep_best,
    link_columns,
    parse_packed_assoc,
    require,
    split_dotted,
    split_locus,
    square_score,
    to_one_based,
    with_biofeature,
    with_score,
    within,
    within_sd,
    without_chr,
)
from regulink.operators.joins import fits_broadcast, lookup_join, skew_join
from regulink.operators.liftover import liftover, unmatched_chromosomes
from regulink.operators.membership import with_keys
from regulink.operators.qtl import (
    bonferroni,
    classify_cis_trans,
    feature_list,
    neg_log10_pval,
    standardise_qtl,
)
from regulink.operators.ranges import overlap_join
from regulink.operators.ranking import exact_quantiles, number_rows
from regulink.operators.scoring import (
    apply_quantile_grids,
    evidence_score,
    feature_aggregate,
    fit_quantile_grids,
    melt_scores,
    minmax,
    per_source_scores,
    quantile_bins,
    quantile_scale,
    rank_genes,
    variant_gene_scores,
    weights_frame,
    wipe_consequence_feature,
)
from regulink.operators.sketches import describe_slices, distinct_error, merge_slices, rank_error, summarise_slices

__all__ = [name for name in dir() if not name.startswith("_") and name.islower()]
