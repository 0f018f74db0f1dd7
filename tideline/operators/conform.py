"""Bring feeds of different shape to one typed column set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import local_to_instant, surrogate_key

_UNSET = object()


@dataclass(frozen=True)
class Field:
    """One output column.

    `source` is the input column, cast to `type`.  Without a source the column is a
    typed NULL, so feeds that lack it still align.  With a `default`, NULLs are
    replaced and the input may lack the column altogether (it arrived late).  `zone`
    turns a wall clock into an instant, `value` is a constant, and `key_of` hashes
    input columns.
    """

    name: str
    type: str
    source: str | None = None
    default: Any = _UNSET
    zone: str | None = None
    value: Any = _UNSET
    key_of: tuple[str | Column, ...] = ()

    def expression(self, available: set[str]) -> Column:
        if self.key_of:
            return surrogate_key(self.key_of).cast(self.type).alias(self.name)
        if self.value is not _UNSET:
            return F.lit(self.value).cast(self.type).alias(self.name)
        if self.source is None:
            return F.lit(None).cast(self.type).alias(self.name)
        if self.default is not _UNSET:
            default = F.lit(self.default).cast(self.type)
            if self.source.lower() not in available:
                return default.alias(self.name)
            return F.coalesce(F.col(self.source).cast(self.type), default).alias(self.name)
        column = F.col(self.source)
        if self.zone is not None:
            column = local_to_instant(column, self.zone)
        return column.cast(self.type).alias(self.name)


def conform(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Rename, cast and align; no filter, no join.  One output row per input row."""
    available = {name.lower() for name in df.columns}
    return df.select(*[field.expression(available) for field in fields])


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """All rows of all feeds, matched by column name; the column sets must be equal."""
    return reduce(lambda left, right: left.unionByName(right), feeds)
