from locus.sources.readers import (
    ensure_not_empty,
    file_date_from_path,
    normalize_case_report,
    parse_case_reports,
    read_case_reports,
    read_psv,
    read_source_csv,
    source_paths,
    unify_headers,
)
from locus.sources.tables import TableStore
from locus.sources.writers import land_json, land_psv

__all__ = [name for name in dir() if not name.startswith("_")]
