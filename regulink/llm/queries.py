"""The corpus queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regulink.llm.collocations import OP11_SQL, op11_collocations
from regulink.llm.decontamination import op9_decontamination
from regulink.llm.fingerprints import op2_fingerprints
from regulink.llm.languages import op7_language_id
from regulink.llm.masked_lm import op3_masked_lm
from regulink.llm.near_dedup import op1_near_dedup
from regulink.llm.nearest import op13_nearest
from regulink.llm.packing import op10_best_fit_packing
from regulink.llm.personal_data import op4_personal_data
from regulink.llm.quality import op8_quality
from regulink.llm.token_counts import op6_token_counts
from regulink.llm.url_filter import OP5_SQL, op5_url_filter
from regulink.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_near_dedup,
        op2_fingerprints,
        op3_masked_lm,
        op4_personal_data,
        op5_url_filter,
        op6_token_counts,
        op7_language_id,
        op8_quality,
        op9_decontamination,
        op10_best_fit_packing,
        op11_collocations,
        op12_whitening,
        op13_nearest,
    )
}
ORACLES: dict[str, str] = {"op5_url_filter": OP5_SQL, "op11_collocations": OP11_SQL}
