from locus.operators.analytics import (
    avg_mobility_by_state,
    country_profile,
    covid_mobility_trend,
    distinct_keys,
    incident_rate_by_state,
    incident_rate_extremes,
    latest_dates,
    parks_vs_incident,
    table_counts,
    top_countries,
    top_us_counties,
)
from locus.operators.covid import conform_covid, covid_batch, load_covid_fact, route_covid, upsert_covid_fact
from locus.operators.dedup import dedup_latest
from locus.operators.deltas import daily_deltas, refresh_deltas
from locus.operators.dml import conform, patch_rows, upsert
from locus.operators.keys import global_row_number
from locus.operators.locations import (
    missing_locations,
    staging_to_dimension,
    upsert_location_dim,
    with_missing_locations,
)
from locus.operators.mobility import (
    conform_mobility,
    load_mobility_fact,
    mobility_batch,
    route_mobility,
    unmatched_mobility_places,
)
from locus.operators.quality import assert_quality, quality_metrics, quality_report

__all__ = [name for name in dir() if not name.startswith("_")]
