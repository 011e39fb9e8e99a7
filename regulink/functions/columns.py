"""Column expressions used by the operators. All stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from regulink.fixed_values import ALLOWED_CHROMOSOMES


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_part(value: Column | str, pattern: str, index: int) -> Column:
    """Field ``index`` (from 0) of ``value`` split on a regular expression; null when absent."""
    return F.get(F.split(_col(value), pattern), F.lit(index))


def to_long(value: Column | str) -> Column:
    """Whole number, or null when the text is not one."""
    return _col(value).try_cast("long")


def strip_chr(value: Column | str) -> Column:
    """Remove every ``chr``, wherever it stands."""
    return F.replace(_col(value), F.lit("chr"), F.lit(""))


def in_chromosomes(value: Column | str, allowed: list[str] | None = None) -> Column:
    """Whether the chromosome, without ``chr``, is an allowed one."""
    return strip_chr(value).isin(ALLOWED_CHROMOSOMES if allowed is None else allowed)


def gtf_attr(attributes: Column | str, key: str) -> Column:
    """Value of ``key "value"`` in a GTF attribute field; null when the key is absent."""
    pattern = f'(?:^|; ?){re.escape(key)} "([^"]*)"'
    found = F.regexp_extract(_col(attributes), pattern, 1)
    return F.when(_col(attributes).rlike(pattern), found)


def midpoint(start: Column | str, end: Column | str) -> Column:
    return (_col(start) + _col(end)) / F.lit(2)


def midpoint_distance(start: Column | str, end: Column | str, anchor: Column | str) -> Column:
    """Distance between the middle of an interval and a position."""
    return F.abs(midpoint(start, end) - _col(anchor))


def neg_log10(pval: Column | str) -> Column:
    """``-log10(p)``; null for p = 0."""
    return -F.log10(_col(pval))


def clean_score(score: Column | str) -> Column:
    """A score with NaN read as missing."""
    score = _col(score)
    return F.when(~F.isnan(score), score)


def path_tag(pattern: str, group: int = 1) -> Column:
    """Text taken from the path of the file a row was read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)
