"""Sources: delimited/text readers, SQL view, string-frame typing, RDD facade."""

from .tsv import (
    cast_events,
    cast_events_with_rejects,
    header_line,
    load_lines_rdd,
    parse_lines,
    parse_lines_with_rejects,
    read_events,
    read_events_with_rejects,
    read_lines,
    register_events_view,
    write_events_tsv,
)

__all__ = [
    "cast_events",
    "cast_events_with_rejects",
    "header_line",
    "load_lines_rdd",
    "parse_lines",
    "parse_lines_with_rejects",
    "read_events",
    "read_events_with_rejects",
    "read_lines",
    "register_events_view",
    "write_events_tsv",
]
