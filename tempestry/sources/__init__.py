"""Reading, writing and inspecting event files."""

from tempestry.sources.csv_files import (
    conform,
    normalize_layout,
    read_events_csv,
    read_many,
)
from tempestry.sources.inspection import (
    cache_clean,
    dataset_overview,
    null_profile,
    sample_events,
)
from tempestry.sources.lines import (
    field_count,
    mark_valid,
    parse_csv_lines,
    split_valid_rejects,
    strip_header,
)
from tempestry.sources.links import extract_links
from tempestry.sources.sinks import write_by_year, write_csv, write_metrics_json

__all__ = [
    "cache_clean",
    "conform",
    "dataset_overview",
    "extract_links",
    "field_count",
    "mark_valid",
    "normalize_layout",
    "null_profile",
    "parse_csv_lines",
    "read_events_csv",
    "read_many",
    "sample_events",
    "split_valid_rejects",
    "strip_header",
    "write_by_year",
    "write_csv",
    "write_metrics_json",
]
