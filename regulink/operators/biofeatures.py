"""Tissue and cell-type labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regulink.fixed_values import (
    COMPOSITE_LABEL_SOURCE,
    EQTL_LABEL_SOURCE,
    EQTL_QUANT_METHODS,
    EQTL_STUDY_RENAMES,
    PLAIN_CONDITION,
)
from regulink.operators.joins import lookup_join
from regulink.schemas import LABEL_COLUMNS


def filter_quant(
    df: DataFrame, methods: Sequence[str] = tuple(EQTL_QUANT_METHODS), position: int = 7
) -> DataFrame:
    """Metadata rows whose column at ``position`` (from 1) is one of the methods."""
    return df.where(F.col(df.columns[position - 1]).isin(list(methods)))


def make_biofeature_labels(df: DataFrame, source: str = EQTL_LABEL_SOURCE) -> DataFrame:
    """Label rows from study metadata: tissue plus condition, unless the condition is plain."""
    label = F.concat("tissue_label", F.lit(" "), "condition_label")
    label = F.replace(F.replace(label, F.lit(PLAIN_CONDITION), F.lit("")), F.lit("_"), F.lit(" "))
    study = F.col("study")
    for old, new in EQTL_STUDY_RENAMES.items():
        study = F.replace(study, F.lit(old), F.lit(new))
    return df.select(
        F.lit(source).alias("original_source"),
        study.alias("study"),
        F.col("qtl_group").alias("biofeature_string"),
        F.upper("qtl_group").alias("biofeature_code"),
        F.col("tissue_ontology_id").alias("biofeature_ontology_term"),
        label.alias("label"),
        "tissue_label",
        "condition_label",
    )


def make_composites(df: DataFrame) -> DataFrame:
    """Label rows named by study and biofeature together, for rows that have a study."""
    return df.where(F.col("study").isNotNull()).withColumns(
        {
            "original_source": F.lit(COMPOSITE_LABEL_SOURCE),
            "biofeature_string": F.concat("study", F.lit("-"), "biofeature_string"),
            "biofeature_code": F.concat("study", F.lit("-"), "biofeature_code"),
        }
    )


def concat_labels(*tables: DataFrame) -> DataFrame:
    """Label tables one after another; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def label_table(*tables: DataFrame) -> DataFrame:
    """All labels followed by their composite rows."""
    labels = concat_labels(*tables)
    present = [name for name in LABEL_COLUMNS if name in labels.columns]
    labels = labels.select(present)
    return concat_labels(labels, make_composites(labels))


def _codes(labels: DataFrame) -> DataFrame:
    return labels.select(
        F.col("biofeature_string").alias("_label"), F.col("biofeature_code").alias("_code")
    ).distinct()


def map_biofeature(
    df: DataFrame, labels: DataFrame, col: str = "bio_feature", strict: bool = True
) -> DataFrame:
    """Replace a biofeature name by its code.

    ``strict`` makes the job fail, naming the label, when a row has no code; otherwise such rows
    get null. A name with several codes gives a row for each.
    """
    code = F.col("_code")
    if strict:
        message = F.concat(F.lit("no biofeature code for: "), F.coalesce(F.col(col), F.lit("null")))
        code = F.when(code.isNull(), F.raise_error(message)).otherwise(code)
    return (
        lookup_join(df.withColumn("_label", F.col(col)), _codes(labels), ["_label"], "left")
        .withColumn(col, code)
        .drop("_label", "_code")
    )


def lookup_biofeature(
    df: DataFrame, labels: DataFrame, order: str, col: str = "bio_feature", strict: bool = True
) -> DataFrame:
    """As :func:`map_biofeature`, but for a name listed twice the last in ``order`` counts."""
    last = labels.groupBy("biofeature_string").agg(
        F.max_by("biofeature_code", order).alias("biofeature_code")
    )
    return map_biofeature(df, last, col, strict)


def missing_labels(df: DataFrame, labels: DataFrame, col: str = "bio_feature") -> DataFrame:
    """Names without a code, each once with its number of rows."""
    counted = df.groupBy(F.col(col).alias("_label")).agg(F.count(F.lit(1)).alias("rows"))
    known = _codes(labels).where(F.col("_code").isNotNull())
    return counted.join(known, "_label", "left_anti").select(F.col("_label").alias(col), "rows")


def remap_biofeatures(
    df: DataFrame, remap: DataFrame, study: str = "study_id", feature: str = "bio_feature"
) -> DataFrame:
    """Old study and biofeature names to new ones; names not listed stay.

    An old pair with several new pairs gives a row for each.
    """
    lookup = remap.select(
        F.col("old_study_id").alias("_old_study"),
        F.col("old_bio_feature_code").alias("_old_feature"),
        F.col("study_id").alias("_new_study"),
        F.col("biofeature_code").alias("_new_feature"),
    ).distinct()
    data = df.withColumns({"_old_study": F.col(study), "_old_feature": F.col(feature)})
    return (
        lookup_join(data, lookup, ["_old_study", "_old_feature"], "left")
        .withColumns(
            {
                study: F.coalesce("_new_study", study),
                feature: F.coalesce("_new_feature", feature),
            }
        )
        .drop("_old_study", "_old_feature", "_new_study", "_new_feature")
    )
