"""Labels for codes that a lookup does not know."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def unknown_label(label: str, code: Column) -> Column:
    """`Unknown <label> (<code>)`; NULL for a NULL code, as `concat` is."""
    return F.concat(F.lit(f"Unknown {label} ("), code.cast("string"), F.lit(")"))


def label_or_unknown(found: Column, label: str, code: Column) -> Column:
    return F.coalesce(found, unknown_label(label, code))


def is_sentinel(code: Column, sentinels: Iterable[int]) -> Column:
    """True for reserved codes, which are kept and flagged rather than dropped."""
    return code.cast("bigint").isin(list(sentinels))
