"""Interval links from four kinds of source, each one plan from scan to links.

Every function returns links (chrom, start, end, gene_id, score, bio_feature) on the target
assembly, ready for ``write_sorted``. ``blocks`` is an assembly chain table; without it links stay
on the assembly of the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink.fixed_values import (
    CAPTURE_MAX_DISTANCE,
    ENHANCER_MAX_DISTANCE,
    GENE_LIST_SD_MULTIPLE,
    MAX_LENGTH_DRIFT,
    UNSPECIFIED_FEATURE,
)
from regulink.operators.biofeatures import map_biofeature
from regulink.operators.genes import (
    add_gene_position,
    gene_name_map,
    map_gene_names,
    map_symbols,
    map_symbols_from_gtf,
    transcript_tss,
)
from regulink.operators.intervals import (
    LINK_KEY,
    add_distance,
    cis_only,
    explode_genes,
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
from regulink.operators.liftover import liftover
from regulink.operators.ranges import overlap_join
from regulink.schemas import INTERVAL_LINKS
from regulink.session import freeze

LINK_COLUMNS = INTERVAL_LINKS.fieldNames()


def gene_tss(gtf: DataFrame, protein_coding: bool = True) -> DataFrame:
    """Start sites of genes, for the overlap with capture baits."""
    return transcript_tss(gtf, protein_coding)


def _lifted(df: DataFrame, blocks: DataFrame | None, maxdiff: int) -> DataFrame:
    return df if blocks is None else liftover(df, blocks, maxdiff)


def build_gene_list_links(
    links: DataFrame,
    genes: DataFrame,
    labels: DataFrame,
    blocks: DataFrame | None = None,
    maxdiff: int = MAX_LENGTH_DRIFT,
    strict: bool = True,
    sd_multiple: float = GENE_LIST_SD_MULTIPLE,
) -> DataFrame:
    """Links listed as gene names per dotted interval, from ``read_links_csv``.

    Names are matched with synonyms. Positions are not shifted. Links farther from the gene than
    ``sd_multiple`` standard deviations of all links are dropped; nothing is de-duplicated.

    Intervals are converted before their gene lists are taken apart, so once per interval. Names get
    the genes and their positions before links meet them, so links to other chromosomes are dropped in
    that join and not shuffled again. The links that are left are read twice, for the deviation and for
    the filter, and so written once.
    """
    placed = without_chr(split_dotted(require(links, "gene_names")))
    coded = map_biofeature(
        placed.withColumnRenamed("biofeature_string", "bio_feature"), labels, strict=strict
    )
    intervals = coded.select("chrom", "start", "end", "gene_names", "bio_feature")
    names = add_gene_position(require(gene_name_map(genes), "gene_id"), genes)
    named = map_gene_names(explode_genes(_lifted(intervals, blocks, maxdiff)), names, once=True)
    cis = add_distance(cis_only(require(named, "gene_id")), "gene_mid")
    kept = freeze(with_score(cis).select(*LINK_COLUMNS, "distance"), "cis-links")
    return link_columns(within_sd(kept, sd_multiple))


def build_capture_links(
    baits: DataFrame,
    tss: DataFrame,
    labels: DataFrame,
    blocks: DataFrame | None = None,
    maxdiff: int = MAX_LENGTH_DRIFT,
    max_distance: float = CAPTURE_MAX_DISTANCE,
    strict: bool = True,
) -> DataFrame:
    """Links from capture baits to the places they touch.

    ``baits`` has the bait (``chrom, start, end``), the place it touches with its score
    (``target``, as ``chr:start-end,score``) and ``bio_feature``; ``tss`` comes from
    :func:`gene_tss`. A bait stands for every gene with a start site in it.
    """
    bait = ["bait_chrom", "bait_start", "bait_end"]
    shaped = without_chr(baits).select(
        *[F.col(a).alias(b) for a, b in zip(("chrom", "start", "end"), bait)],
        "target",
        "bio_feature",
    )
    touched = without_chr(split_locus(shaped, "target")).drop("target")
    genes = tss.select("chrom", "start", "end", "name")
    pairs = overlap_join(touched, genes, left_on=bait, prefix="tss_")
    near = within(
        add_distance(cis_only(pairs, "chrom", "tss_chrom"), "tss_start"), max_distance
    ).withColumnRenamed("tss_name", "gene_id")
    best = keep_best(to_one_based(near), [*LINK_KEY, "bio_feature"])
    lifted = _lifted(link_columns(best), blocks, maxdiff)
    return link_columns(map_biofeature(lifted, labels, strict=strict))


def build_enhancer_links(
    associations: DataFrame,
    genes: DataFrame,
    blocks: DataFrame | None = None,
    bio_feature: str = UNSPECIFIED_FEATURE,
    maxdiff: int = MAX_LENGTH_DRIFT,
    max_distance: float = ENHANCER_MAX_DISTANCE,
) -> DataFrame:
    """Links packed in a ``name`` field with a gene symbol and a correlation, which is squared."""
    parsed = square_score(without_chr(parse_packed_assoc(associations.select("name"))))
    lookup = genes.select("gene_name", "gene_id", "chr", "tss")
    mapped = map_symbols(parsed.drop("name"), lookup)
    near = within(add_distance(cis_only(mapped, "chrom", "chr"), "tss"), max_distance)
    best = with_biofeature(to_one_based(keep_best(near)), bio_feature)
    return link_columns(_lifted(link_columns(best), blocks, maxdiff))


def build_correlation_links(
    correlations: DataFrame,
    gtf: DataFrame,
    blocks: DataFrame | None = None,
    bio_feature: str = UNSPECIFIED_FEATURE,
    maxdiff: int = MAX_LENGTH_DRIFT,
    order: str = "line_no",
) -> DataFrame:
    """Links with a gene symbol and a correlation, which is kept as it is; no distance limit.

    ``correlations`` has ``chrom, start, end, gene_symbol, score``.
    """
    mapped = require(map_symbols_from_gtf(without_chr(correlations), gtf, order=order), "gene_id")
    best = with_biofeature(to_one_based(keep_best(mapped)), bio_feature)
    return link_columns(_lifted(link_columns(best), blocks, maxdiff))
