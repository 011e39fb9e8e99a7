"""Text lines to columns, as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regulink.functions import split_part, to_long
from regulink.schemas import CHAIN_BLOCKS, GTF_COLUMNS

_WHOLE_NUMBERS = {"start", "end"}


def parse_gtf(lines: DataFrame, value: str = "value") -> DataFrame:
    """The nine GTF columns of each line that is not a comment; quotes are ordinary text."""
    others = [name for name in lines.columns if name != value]
    fields = []
    for i, name in enumerate(GTF_COLUMNS):
        field = split_part(F.rtrim(value), "\t", i)
        fields.append((to_long(field) if name in _WHOLE_NUMBERS else field).alias(name))
    return lines.where(~F.col(value).startswith("#")).select(*others, *fields)


def parse_vcf_sites(lines: DataFrame, value: str = "value") -> DataFrame:
    """``chrom, pos, ref, alt`` of each line that is not a comment; ``alt`` may be a list."""
    others = [name for name in lines.columns if name != value]
    text = F.rtrim(value)
    return lines.where(~F.col(value).startswith("#")).select(
        *others,
        split_part(text, "\t", 0).alias("chrom"),
        to_long(split_part(text, "\t", 1)).alias("pos"),
        split_part(text, "\t", 3).alias("ref"),
        split_part(text, "\t", 4).alias("alt"),
    )


def vcf_to_bed(sites: DataFrame) -> DataFrame:
    """One BED row per alternative allele, named ``chrom_pos_ref_alt``."""
    return sites.withColumn("alt", F.explode(F.split("alt", ","))).select(
        "chrom",
        (F.col("pos") - 1).alias("start"),
        F.col("pos").alias("end"),
        F.concat_ws("_", "chrom", F.col("pos").cast("string"), "ref", "alt").alias("name"),
        F.lit(".").alias("score"),
    )


def parse_chain(chains: DataFrame, value: str = "value") -> DataFrame:
    """Ungapped blocks of assembly chains, given one text row per chain.

    Block starts are running sums of sizes and gaps inside a chain; positions are half-open from 0.
    On the minus strand target positions count from the far end of the target.
    """
    lines = F.filter(
        F.transform(F.split(value, r"\r?\n"), lambda line: F.trim(line)),
        lambda line: (line != "") & ~line.startswith("#"),
    )
    head = F.split(F.get("_lines", F.lit(0)), r"\s+")
    with_lines = chains.select(lines.alias("_lines")).where(
        F.get("_lines", F.lit(0)).startswith("chain") & F.get(head, F.lit(1)).try_cast("double").isNotNull()
    )
    fields = with_lines.select(
        F.get(head, F.lit(12)).try_cast("long").alias("chain_id"),
        F.get(head, F.lit(1)).try_cast("long").alias("score"),
        F.get(head, F.lit(2)).alias("src_chrom"),
        F.get(head, F.lit(5)).try_cast("long").alias("_src_from"),
        F.get(head, F.lit(7)).alias("tgt_chrom"),
        F.get(head, F.lit(8)).try_cast("long").alias("tgt_size"),
        F.get(head, F.lit(9)).alias("tgt_strand"),
        F.get(head, F.lit(10)).try_cast("long").alias("_tgt_from"),
        F.posexplode(F.slice("_lines", 2, F.size("_lines"))).alias("_i", "_block"),
    )
    part = F.split("_block", r"\s+")

    def number(i: int):
        return F.coalesce(F.get(part, F.lit(i)).try_cast("long"), F.lit(0))

    sized = (
        fields.withColumn("_size", number(0))
        .withColumn("_src_gap", number(1))
        .withColumn("_tgt_gap", number(2))
    )
    # a chain was one text row, so its blocks are few enough for one task
    earlier = (
        Window.partitionBy("chain_id", "src_chrom", "_src_from", "tgt_chrom", "_tgt_from")
        .orderBy("_i")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    src_done = F.coalesce(F.sum(F.col("_size") + F.col("_src_gap")).over(earlier), F.lit(0))
    tgt_done = F.coalesce(F.sum(F.col("_size") + F.col("_tgt_gap")).over(earlier), F.lit(0))
    return (
        sized.withColumn("src_start", F.col("_src_from") + src_done)
        .withColumn("tgt_start", F.col("_tgt_from") + tgt_done)
        .withColumn("src_end", F.col("src_start") + F.col("_size"))
        .select(CHAIN_BLOCKS.fieldNames())
    )
