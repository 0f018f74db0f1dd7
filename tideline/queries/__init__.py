"""Registered queries over the given tables, each with the SQL it is checked against."""

from tideline.queries import conform, dimension, enrich, incremental, landing, published, quality, reference, upkeep
from tideline.queries.registry import REGISTRY

__all__ = ["REGISTRY", "conform", "dimension", "enrich", "incremental", "landing", "published", "quality", "reference", "upkeep"]
