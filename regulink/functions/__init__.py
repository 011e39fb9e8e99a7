"""Column expressions: text parsing, coordinates and scores."""

from regulink.functions.columns import (
    clean_score,
    gtf_attr,
    in_chromosomes,
    midpoint,
    midpoint_distance,
    neg_log10,
    path_tag,
    split_part,
    strip_chr,
    to_long,
)

__all__ = [
    "clean_score",
    "gtf_attr",
    "in_chromosomes",
    "midpoint",
    "midpoint_distance",
    "neg_log10",
    "path_tag",
    "split_part",
    "strip_chr",
    "to_long",
]
