"""Column expressions shared by the operators (all JVM-side built-ins)."""

from .exprs import collapse_repeats, is_error, join_route, parse_long, shift_right

__all__ = ["collapse_repeats", "is_error", "join_route", "parse_long", "shift_right"]
