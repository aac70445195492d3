"""trailspark: most frequent session routes through a site, on Spark.

Typical use::

    from trailspark import read_events, top_routes
    events = read_events(spark, "hdfs:///data/clickstream.tsv")
    top_routes(events, n=10).show()
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship this package's functions to Python workers by value, so executors need
# no installed copy of it (the mapInPandas folds and the RDD facade run there).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .operators import (  # noqa: E402
    cut_broadcast,
    cut_join,
    cut_partition_min,
    cut_window,
    error_events,
    first_error,
    page_changes,
    surviving_changes,
    route_counts,
    routes_fold,
    routes_listagg,
    routes_max_array,
    routes_max_string,
    routes_pandas,
    routes_sorted,
    routes_window,
    running_routes,
    top_n,
    valid_events,
)
from .plans import (  # noqa: E402
    FORMS,
    all_route_counts,
    get_routes,
    session_routes,
    top_pairs,
    top_routes,
    top_routes_rdd,
    top_routes_rdd_df,
    top_routes_rdd_path,
    top_routes_sql,
)
from .sinks import read_tsv, routes_json, top_routes_dict, tsv_lines, write_json, write_tsv  # noqa: E402
from .sources import (  # noqa: E402
    cast_events,
    load_lines_rdd,
    parse_lines,
    read_events,
    read_events_with_rejects,
    read_lines,
    register_events_view,
)

__all__ = [
    "cast_events",
    "FORMS",
    "all_route_counts",
    "cut_broadcast",
    "cut_join",
    "cut_partition_min",
    "cut_window",
    "error_events",
    "first_error",
    "get_routes",
    "load_lines_rdd",
    "page_changes",
    "parse_lines",
    "read_events",
    "read_events_with_rejects",
    "read_lines",
    "read_tsv",
    "register_events_view",
    "route_counts",
    "routes_fold",
    "routes_listagg",
    "routes_json",
    "routes_max_array",
    "routes_max_string",
    "routes_pandas",
    "routes_sorted",
    "routes_window",
    "running_routes",
    "session_routes",
    "surviving_changes",
    "top_n",
    "top_pairs",
    "top_routes",
    "top_routes_dict",
    "top_routes_rdd",
    "top_routes_rdd_df",
    "top_routes_rdd_path",
    "top_routes_sql",
    "tsv_lines",
    "valid_events",
    "write_json",
    "write_tsv",
]
