"""Bronze ingest: feed readers, lineage columns, envelope parsing, schema evolution."""

from voltaic.sources.ingest import *  # noqa: F401,F403
