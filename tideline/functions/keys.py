"""Hash keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "_null_"


def _column(field: str | Column) -> Column:
    return F.col(field) if isinstance(field, str) else field


def surrogate_key(fields: Sequence[str | Column], null_token: str = NULL_TOKEN, separator: str = "-") -> Column:
    """md5 over the text of `fields`.

    A NULL becomes `null_token`: `concat_ws` skips NULLs, and (a, NULL, b) must not
    collide with (a, b).  Pass the token of another tool to get that tool's keys.
    """
    texts = [F.coalesce(_column(f).cast("string"), F.lit(null_token)) for f in fields]
    return F.md5(F.concat_ws(separator, *texts))


def version_key(key: str | Column, valid_from: str | Column) -> Column:
    """One key per version of a dimension member."""
    return F.md5(F.concat_ws("|", _column(key).cast("string"), _column(valid_from).cast("string")))
