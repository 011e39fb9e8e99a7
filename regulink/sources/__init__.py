"""Readers, text parsers and writers."""

from regulink.sources.parsers import parse_chain, parse_gtf, parse_vcf_sites, vcf_to_bed
from regulink.sources.readers import (
    read_bed,
    read_biofeatures,
    read_chain,
    read_consequences,
    read_evidence,
    read_feature_remap,
    read_feature_remap_tsv,
    read_gene_list,
    read_genes,
    read_grids,
    read_gtf,
    read_intervals,
    read_lines,
    read_links_csv,
    read_region,
    read_study_metadata,
    read_sumstats,
    read_vcf_sites,
)
from regulink.sources.writers import (
    add_partitioned,
    dataset_path,
    write_grids,
    write_jsonl,
    write_partitioned,
    write_sorted,
    write_tsv,
)

__all__ = [
    "add_partitioned",
    "dataset_path",
    "parse_chain",
    "parse_gtf",
    "parse_vcf_sites",
    "read_bed",
    "read_biofeatures",
    "read_chain",
    "read_consequences",
    "read_evidence",
    "read_feature_remap",
    "read_feature_remap_tsv",
    "read_gene_list",
    "read_genes",
    "read_grids",
    "read_gtf",
    "read_intervals",
    "read_lines",
    "read_links_csv",
    "read_region",
    "read_study_metadata",
    "read_sumstats",
    "read_vcf_sites",
    "vcf_to_bed",
    "write_grids",
    "write_jsonl",
    "write_partitioned",
    "write_sorted",
    "write_tsv",
]
