"""Scalar and array expressions: error test, route join, repeat collapse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SEPARATOR, TYPE

# Fixed value that must equal the reference's: an event is a browser error
# when its lower-cased type contains this word.
ERROR_WORD = "error"


# A number in text: ASCII digits with an optional sign and nothing around them.
LONG_PATTERN = "^[+-]?[0-9]{1,19}$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_error(event_type: str | Column = TYPE) -> Column:
    """True when the lower-cased type contains ``error``; a null type is not an error."""
    return F.coalesce(F.lower(_col(event_type)).contains(ERROR_WORD), F.lit(False))


def parse_long(text: str | Column) -> Column:
    """The number a text holds, or null: one rule for every reader (V4)."""
    c = _col(text)
    return F.when(c.rlike(LONG_PATTERN), c.try_cast("bigint"))


def join_route(pages: str | Column) -> Column:
    """Route text: pages joined with ``-``."""
    return F.concat_ws(SEPARATOR, _col(pages))


def shift_right(arr: str | Column, element_type: str) -> Column:
    """``[null, a0, a1, ...]``: each element's predecessor sits at the same index."""
    return F.concat(F.array(F.lit(None).cast(element_type)), _col(arr))


def collapse_repeats(pages: str | Column) -> Column:
    """Drop every element equal to the one before it (``A A B A`` -> ``A B A``).

    Pairs each page with its predecessor via ``zip_with`` instead of indexing
    the array inside a lambda, so the work stays linear in the array length.
    Pages are never null after ingest, so ``array_compact`` only removes the
    dropped positions.
    """
    p = _col(pages)
    kept = F.zip_with(
        p, shift_right(p, "string"), lambda cur, prev: F.when(prev.isNull() | (cur != prev), cur)
    )
    return F.array_compact(kept)
