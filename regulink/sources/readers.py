"""Readers. Schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regulink import schemas
from regulink.functions import path_tag, split_part
from regulink.sources.parsers import parse_chain, parse_gtf, parse_vcf_sites
from regulink.sources.writers import INTERVAL_ORDER, manifest_path

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _missing_as_null(df: DataFrame) -> DataFrame:
    """NaN in number columns means missing."""
    return df.select(
        [
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def read_intervals(spark: SparkSession, paths: Paths) -> DataFrame:
    """Interval links from headered TSV files; columns are taken by position, not by name."""
    return _missing_as_null(
        spark.read.csv(_paths(paths), schema=schemas.INTERVAL_LINKS, sep="\t", header=True)
    )


def read_sumstats(spark: SparkSession, path: Paths) -> DataFrame:
    """QTL summary statistics from Parquet."""
    return spark.read.parquet(*_paths(path))


def read_genes(spark: SparkSession, path: Paths) -> DataFrame:
    """Gene dictionary from JSON lines, either shape; absent fields are null."""
    return spark.read.schema(schemas.GENES).json(_paths(path))


def read_biofeatures(spark: SparkSession, paths: Paths) -> DataFrame:
    """Biofeature labels from JSON lines whose fields differ between files."""
    return spark.read.schema(schemas.BIOFEATURES).json(_paths(paths))


def read_feature_remap(spark: SparkSession, path: Paths) -> DataFrame:
    """Old and new (study, biofeature) names from JSON lines."""
    return spark.read.schema(schemas.FEATURE_REMAP).json(_paths(path))


def read_feature_remap_tsv(spark: SparkSession, path: Paths) -> DataFrame:
    """Old and new (study, biofeature) names from headered TSV, whatever other columns it has."""
    table = spark.read.csv(_paths(path), sep="\t", header=True)
    return table.select([F.col(f"`{name}`") for name in schemas.FEATURE_REMAP.fieldNames()])


def read_study_metadata(spark: SparkSession, path: Paths) -> DataFrame:
    """Study metadata from headered TSV, every column as text in the order of the file."""
    return spark.read.csv(_paths(path), sep="\t", header=True)


def read_gene_list(spark: SparkSession, path: Paths) -> DataFrame:
    """One gene id per line, without a header."""
    return spark.read.text(_paths(path)).select(F.trim("value").alias("gene_id")).where(
        F.col("gene_id") != ""
    )


def read_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Text lines with ``line_no``, which sorts in file and line order."""
    return spark.read.text(_paths(paths)).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("line_no"),
    )


def read_gtf(spark: SparkSession, paths: Paths) -> DataFrame:
    """Gene annotation lines, with ``line_no``."""
    return parse_gtf(read_lines(spark, paths))


def read_vcf_sites(spark: SparkSession, paths: Paths) -> DataFrame:
    """Variant sites of VCF files."""
    return parse_vcf_sites(spark.read.text(_paths(paths)))


def read_chain(spark: SparkSession, path: Paths) -> DataFrame:
    """Blocks of an assembly chain file, with either kind of line end.

    The word that begins a header line parts the chains; what stands before the first is dropped.
    """
    chains = spark.read.text(_paths(path), lineSep="chain ")
    return parse_chain(chains.select(F.concat(F.lit("chain "), "value").alias("value")))


def read_links_csv(spark: SparkSession, path: Paths) -> DataFrame:
    """Gene-list links from headered CSV."""
    return spark.read.csv(_paths(path), schema=schemas.GENE_LIST_LINKS, header=True)


def read_bed(
    spark: SparkSession,
    path: Paths,
    columns: Mapping[str, tuple[int, str]],
    skip_prefixes: Sequence[str] = ("track", "browser", "#"),
    tag: Mapping[str, str] | None = None,
) -> DataFrame:
    """Columns of a headerless tab-separated file, as ``name -> (position, type)``.

    Lines with a skipped prefix are left out. ``tag`` adds columns taken from the file path,
    as ``name -> regular expression with one group``, so many files are one scan.
    """
    lines = spark.read.text(_paths(path))
    tags = [
        path_tag(pattern).alias(name) for name, pattern in (tag or {}).items()
    ]
    for prefix in skip_prefixes:
        lines = lines.where(~F.col("value").startswith(prefix))
    return lines.select(
        *[
            split_part("value", "\t", position).try_cast(kind).alias(name)
            for name, (position, kind) in columns.items()
        ],
        *tags,
    )


def read_evidence(spark: SparkSession, path: Paths) -> DataFrame:
    """Evidence rows from headerless 19-column TSV."""
    return _missing_as_null(spark.read.csv(_paths(path), schema=schemas.EVIDENCE, sep="\t"))


def read_consequences(
    spark: SparkSession, path: Paths, term_col: str = "Term", score_col: str = "v2g_score"
) -> DataFrame:
    """Consequence weights (``term``, ``weight``) from headered TSV; an empty weight is null."""
    return spark.read.csv(_paths(path), sep="\t", header=True).select(
        F.col(f"`{term_col}`").alias("term"),
        F.col(f"`{score_col}`").try_cast("double").alias("weight"),
    )


def read_region(
    spark: SparkSession,
    path: str,
    chrom: str,
    start: int | None = None,
    end: int | None = None,
    order: Sequence[str] = INTERVAL_ORDER,
) -> DataFrame:
    """Rows of a table of ``write_sorted`` that touch ``start .. end`` of a chromosome.

    The manifest says which files can hold them, and only these are opened. A table without rows has
    no manifest and no such rows.
    """
    place, last = order[1], order[-1]
    root = path.rstrip("/")
    whole = spark.read.parquet(root)
    wanted = (F.col(order[0]) == chrom,) + ((F.col(last) >= start,) if start is not None else ())
    wanted += (F.col(place) <= end,) if end is not None else ()
    if whole.isEmpty():
        return whole
    listed = spark.read.parquet(manifest_path(root)).where(F.col("part") == chrom)
    if start is not None:
        listed = listed.where(F.col("farthest") >= start)
    if end is not None:
        listed = listed.where(F.col("first") <= end)
    files = [f"{root}/{r['file']}" for r in listed.select("file").distinct().collect()]
    rows = spark.read.schema(whole.schema).parquet(*files) if files else whole.where(F.lit(False))
    for condition in wanted:
        rows = rows.where(condition)
    return rows


def read_grids(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """Quantile grids of a version, by default the last one in the order of names."""
    table = spark.read.parquet(root)
    if version is None:
        version = table.agg(F.max(F.col("version").cast("string"))).first()[0]
    found = table.where(F.col("version").cast("string") == version).drop("version")
    if version is None or found.isEmpty():
        raise ValueError(f"no quantile grids of version {version} at {root}")
    return found
