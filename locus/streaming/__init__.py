from locus.streaming.ingest import ingest_new_reports

__all__ = ["ingest_new_reports"]
