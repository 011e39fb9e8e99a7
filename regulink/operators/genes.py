"""Gene annotation, gene dictionaries and mapping of symbols to gene ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink.functions import gtf_attr, midpoint, midpoint_distance
from regulink.operators.joins import lookup_join

PROTEIN_CODING = "protein_coding"


def gtf_features(gtf: DataFrame, kind: str) -> DataFrame:
    """Annotation lines of one feature type."""
    return gtf.where(F.col("feature") == kind)


def coding_transcripts(gtf: DataFrame) -> DataFrame:
    """Lines whose attribute text names the protein-coding transcript biotype."""
    return gtf.where(F.col("attributes").contains(f'transcript_biotype "{PROTEIN_CODING}"'))


def coding_genes(genes: DataFrame) -> DataFrame:
    """Dictionary genes of the protein-coding biotype."""
    return genes.where(F.col("biotype") == PROTEIN_CODING)


def transcript_tss(gtf: DataFrame, protein_coding: bool = False) -> DataFrame:
    """Distinct start sites of transcripts, as BED rows named by gene id.

    The site is the first base on the plus strand and the last on the minus strand; lines without
    a strand have no site (see :func:`strand_report`).
    """
    lines = gtf_features(gtf, "transcript")
    if protein_coding:
        lines = coding_transcripts(lines)
    site = F.when(F.col("strand") == "+", F.col("start")).when(
        F.col("strand") == "-", F.col("end")
    )
    return (
        lines.select(
            F.col("seqname").alias("chrom"),
            (site - 1).alias("start"),
            site.alias("end"),
            gtf_attr("attributes", "gene_id").alias("name"),
            F.lit(".").alias("score"),
        )
        .where(F.col("end").isNotNull())
        .distinct()
    )


def strand_report(gtf: DataFrame) -> DataFrame:
    """How many transcripts have a strand, and how many are left out for want of one."""
    stranded = F.coalesce(F.col("strand").isin("+", "-"), F.lit(False)).cast("int")
    return gtf_features(gtf, "transcript").agg(
        F.coalesce(F.sum(stranded), F.lit(0)).alias("stranded"),
        F.coalesce(F.sum(1 - stranded), F.lit(0)).alias("unstranded"),
    )


def map_symbols(
    df: DataFrame, genes: DataFrame, symbol: str = "gene_symbol", case_insensitive: bool = False
) -> DataFrame:
    """Add ``gene_id`` and gene position by upper-cased symbol; unmatched rows go.

    Dictionary names are compared as stored unless ``case_insensitive``. Genes that share a name
    each give a row.
    """
    name = F.upper("gene_name") if case_insensitive else F.col("gene_name")
    kept = [c for c in genes.columns if c not in ("gene_name", symbol)]
    lookup = genes.where(F.col("gene_id").isNotNull()).select(name.alias("_symbol"), *kept)
    data = df.withColumn(symbol, F.upper(symbol)).withColumn("_symbol", F.col(symbol))
    return lookup_join(data, lookup, ["_symbol"], "inner").drop("_symbol")


def symbol_map_from_gtf(gtf: DataFrame, order: str = "line_no") -> DataFrame:
    """Upper-cased gene symbol to gene id; for a repeated symbol the last line counts."""
    lines = gtf_features(gtf, "gene").select(
        F.upper(gtf_attr("attributes", "gene_name")).alias("gene_symbol"),
        gtf_attr("attributes", "gene_id").alias("gene_id"),
        order,
    )
    return (
        lines.where(F.col("gene_symbol").isNotNull())
        .groupBy("gene_symbol")
        .agg(F.max_by("gene_id", order).alias("gene_id"))
    )


def map_symbols_from_gtf(
    df: DataFrame, gtf: DataFrame, symbol: str = "gene_symbol", order: str = "line_no"
) -> DataFrame:
    """Swap a symbol for the gene id of the annotation; unmatched rows go."""
    lookup = symbol_map_from_gtf(gtf, order).where(F.col("gene_id").isNotNull())
    data = df.withColumn("gene_symbol", F.upper(symbol))
    return lookup_join(data, lookup, ["gene_symbol"], "inner").drop("gene_symbol")


def official_names(genes: DataFrame) -> DataFrame:
    return genes.select("gene_name", "gene_id")


def synonym_names(genes: DataFrame) -> DataFrame:
    """Synonyms that are nobody's official name."""
    synonyms = genes.select(F.explode("gene_synonyms").alias("gene_name"), "gene_id")
    # packed dictionaries are much larger in memory than Spark's estimate, which would broadcast all their names
    return synonyms.join(official_names(genes).hint("merge"), "gene_name", "left_anti")


def gene_name_map(genes: DataFrame) -> DataFrame:
    """Official names, then synonyms that clash with none of them, to gene ids."""
    return official_names(genes).unionByName(synonym_names(genes))


def map_gene_names(df: DataFrame, name_map: DataFrame, once: bool = False) -> DataFrame:
    """Add ``gene_id``, and what else ``name_map`` has, by ``gene_name``; rows without a match keep a null id."""
    return lookup_join(df, name_map, ["gene_name"], "left", once=once)


def gene_midpoint(genes: DataFrame) -> DataFrame:
    """``gene_id, gene_chrom, gene_mid``."""
    return genes.select(
        "gene_id", "gene_chrom", midpoint("gene_start", "gene_end").alias("gene_mid")
    )


def add_gene_position(df: DataFrame, genes: DataFrame) -> DataFrame:
    """Add the gene's chromosome and midpoint by ``gene_id``; unmatched rows stay."""
    return lookup_join(df, gene_midpoint(genes), ["gene_id"], "left")


def link_distances(
    links: DataFrame, genes: DataFrame, chrom: str = "chr", anchor: str = "tss"
) -> DataFrame:
    """Links on their gene's chromosome with ``delta``, the distance to the gene's anchor."""
    lookup = genes.select("gene_id", F.col(chrom).alias("_chr"), F.col(anchor).alias("_anchor"))
    return (
        lookup_join(links, lookup, ["gene_id"], "inner", once=True)
        .where(F.col("chrom") == F.col("_chr"))
        .withColumn("delta", midpoint_distance("start", "end", "_anchor"))
        .drop("_chr", "_anchor")
    )
