"""File streams."""

from tideline.streaming.ingest import stream_copy_into
from tideline.streaming.restated import newest_versions, stream_versions

__all__ = ["newest_versions", "stream_copy_into", "stream_versions"]
