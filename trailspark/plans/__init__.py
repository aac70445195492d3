"""Whole-query plans: DataFrame forms, SQL statement, RDD facade."""

from .flagship import DEFAULT_FORM, FORMS, all_route_counts, session_routes, top_routes
from .rdd import (
    fold_session,
    get_routes,
    route_pairs_rdd,
    top_pairs,
    top_routes_rdd,
    top_routes_rdd_df,
    top_routes_rdd_path,
)
from .sql import top_routes_sql, top_routes_sql_text

__all__ = [
    "DEFAULT_FORM",
    "FORMS",
    "all_route_counts",
    "fold_session",
    "get_routes",
    "route_pairs_rdd",
    "session_routes",
    "top_pairs",
    "top_routes",
    "top_routes_rdd",
    "top_routes_rdd_df",
    "top_routes_rdd_path",
    "top_routes_sql",
    "top_routes_sql_text",
]
