"""The biofeature label table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from regulink.operators.biofeatures import filter_quant, label_table, make_biofeature_labels


def build_biofeature_map(
    metadata: DataFrame, *others: DataFrame, methods=None, method_position: int = 7
) -> DataFrame:
    """Labels of a study catalogue together with other label tables, then composite rows of all."""
    kept = (
        filter_quant(metadata, position=method_position)
        if methods is None
        else filter_quant(metadata, methods, method_position)
    )
    return label_table(*others, make_biofeature_labels(kept))
