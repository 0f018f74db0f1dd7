"""Lakehouse operators on PySpark: ingest once, conform, enrich, merge, version, test."""

from tideline.session import build_session, pin, shared_dir

__all__ = ["build_session", "pin", "shared_dir"]
