"""Lazy ``DataFrame -> DataFrame`` operators of the route pipeline."""

from .buckets import stitch, valid_events, with_bucket
from .collapse import page_changes, surviving_changes
from .counts import DEFAULT_N, route_counts, top_n
from .cut import (
    cut_broadcast,
    cut_join,
    cut_partition_min,
    cut_window,
    error_events,
    first_error,
)
from .pandas_fold import routes_pandas
from .paths import (
    fragments,
    routes_fold,
    routes_listagg,
    routes_max_array,
    routes_max_string,
    routes_sorted,
    routes_window,
    running_routes,
)

__all__ = [
    "DEFAULT_N",
    "cut_broadcast",
    "cut_join",
    "cut_partition_min",
    "cut_window",
    "error_events",
    "first_error",
    "fragments",
    "page_changes",
    "route_counts",
    "routes_fold",
    "routes_listagg",
    "routes_max_array",
    "routes_max_string",
    "routes_pandas",
    "routes_sorted",
    "routes_window",
    "running_routes",
    "stitch",
    "surviving_changes",
    "top_n",
    "valid_events",
    "with_bucket",
]
