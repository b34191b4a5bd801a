"""DataFrame -> DataFrame operators: staging, scopes, marts, ingestion, quality, reports, sinks."""

from . import ingest, joins, marts, quality, reports, scopes, sinks, staging

__all__ = ["ingest", "joins", "marts", "quality", "reports", "scopes", "sinks", "staging"]
