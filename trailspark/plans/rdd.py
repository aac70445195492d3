"""RDD facade of the route query (Q7): fold buckets, merge their states by session, count.

Events are folded per ``(session, bucket)``: the first error, and the collapsed
pages before it, as one text. These fragments are dealt out by session and sorted
by bucket, and a task reads them one by one: it holds the route of the session
it is at, and drops what lies behind an error. The sorts go to disk when a worker's
memory (``spark.python.worker.memory``) is used up, so no task holds more of the
input, however large its share is. ``merge_states`` is the same for states in any
order and grouping.

* ``route_pairs_rdd`` takes a frame: Spark's own aggregates fold the buckets,
  and one row per bucket reaches Python.
* ``get_routes`` takes an RDD of 5-string tuples, as ``load_lines_rdd`` gives, and
  folds the buckets in Python.

The result is the top ``n`` list, ordered by count then route.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import add

from pyspark import RDD
from pyspark.rdd import portable_hash
from pyspark.sql import DataFrame

from ..functions.exprs import ERROR_WORD, LONG_PATTERN
from ..operators.buckets import BUCKET, CUT, PAGES
from ..operators.counts import DEFAULT_N
from ..operators.paths import fragments
from ..schema import BUCKET_SECONDS, ROUTE_COUNTS_SCHEMA, SEPARATOR, SESSION, USER

#: ``(first bucket with an error or None, {bucket: pages})``
State = tuple["int | None", dict[int, tuple[str, ...]]]
#: ``(has an error, text of the pages, their number, first, last)``
Fragment = tuple[bool, str, int, str, str]
#: Parts of a shuffle for each part of its input: small ones, as Python rows take many times
#: their bytes.
SPREAD = 8


def collapsed(pages: Iterable[str]) -> list[str]:
    out: list[str] = []
    for page in pages:
        if not out or out[-1] != page:
            out.append(page)
    return out


def fold_bucket(events: Iterable[tuple]) -> tuple[int | None, tuple[str, ...]]:
    """First error time and collapsed pages before it, from ``(timestamp, tie, page,
    is_error)`` tuples in any order (U1)."""
    events = sorted(events)
    error_ts = min((e[0] for e in events if e[3]), default=None)
    return error_ts, tuple(collapsed(e[2] for e in events if error_ts is None or e[0] < error_ts))


def fold_sorted(events: Iterable[tuple]) -> tuple[int | None, list[str]]:
    """``fold_bucket`` of events in order, which holds the pages only."""
    pages: list[str] = []
    kept, second, error_ts = 0, None, None
    for ts, _, page, is_error in events:
        if error_ts is not None and ts > error_ts:
            continue
        if ts != second:  # what an error in the same second takes back
            kept, second = len(pages), ts
        if is_error:
            error_ts = ts
        elif not pages or pages[-1] != page:
            pages.append(page)
    return error_ts, pages if error_ts is None else pages[:kept]


def fold_session(events: Iterable[tuple]) -> str:
    """Route of one session's ``(timestamp, tie, page, is_error)`` tuples."""
    return SEPARATOR.join(fold_bucket(events)[1])


def bucket_state(bucket: int, error_ts: int | None, pages: Iterable[str]) -> State:
    return (None if error_ts is None else bucket), {bucket: tuple(pages)}


def merge_states(a: State, b: State) -> State:
    """Both states in one; associative and commutative. The larger one takes the other in."""
    if len(a[1]) < len(b[1]):
        a, b = b, a
    stops = [s for s in (a[0], b[0]) if s is not None]
    stop = min(stops, default=None)
    kept = a[1]
    if stop is not None and stop != a[0]:
        kept = {k: v for k, v in kept.items() if k <= stop}
    for k, v in b[1].items():
        if stop is None or k <= stop:
            kept[k] = v
    return stop, kept


def state_route(state: State) -> str:
    stop, parts = state
    pages = (p for k in sorted(parts) if stop is None or k <= stop for p in parts[k])
    return SEPARATOR.join(collapsed(pages))


def _sorted_by(rdd: RDD, key_length: int, partitions: int) -> RDD:
    """Pairs dealt out by the first ``key_length`` parts of their keys and sorted by the whole ones."""
    return rdd.repartitionAndSortWithinPartitions(
        partitions, lambda k: portable_hash(k[:key_length]))


def fragment(error_ts: int | None, pages: list[str]) -> Fragment:
    """A bucket's collapsed pages as one text, which takes a part of their memory."""
    return (error_ts is not None, SEPARATOR.join(pages), len(pages),
            pages[0] if pages else "", pages[-1] if pages else "")


def fragments_route(parts: Iterable[Fragment]) -> tuple[str, int]:
    """Route of a session's fragments in bucket order, and its number of pages; a page
    repeated over a boundary collapses, and nothing behind the first error counts."""
    texts, total, end = [], 0, None
    for error, text, n, first, last in parts:
        if n and first == end:
            n, text = n - 1, text[len(first) + len(SEPARATOR):]
        if n:
            texts.append(text)
            total, end = total + n, last
        if error:
            break
    return SEPARATOR.join(texts), total


def _routes(parts: RDD, partitions: int) -> RDD:
    """``(route, 1)`` per session from ``((user, session, bucket), fragment)`` pairs."""
    def routes(rows: Iterable[tuple]) -> Iterator[tuple[str, int]]:
        for _, group in groupby(rows, key=lambda kv: kv[0][:2]):
            route, _ = fragments_route(kv[1] for kv in group)
            if route != "":
                yield route, 1

    return _sorted_by(parts, 2, partitions).mapPartitions(routes)


def route_pairs_rdd(events: DataFrame, seq: str | None = None, width: int = BUCKET_SECONDS) -> RDD:
    """``(route, 1)`` pairs of a frame's sessions."""
    rows = fragments(events, seq, width).select(USER, SESSION, BUCKET, CUT, PAGES).rdd
    return _routes(rows.map(lambda r: ((r[0], r[1], r[2]), fragment(r[3], r[4]))),
                   SPREAD * rows.getNumPartitions())


def get_routes(records: RDD, width: int = BUCKET_SECONDS) -> RDD:
    """``(route, 1)`` pairs from 5-string tuples ``(user, session, type, page, timestamp)``.

    By the readers' rule: records with an id or time that is no number, or
    without a page, are left out. Ties go by page. Copies of an event are
    dropped as the sorted events of a bucket are read.
    """
    number = re.compile(LONG_PATTERN.rstrip("$") + r"\Z")
    limit = 1 << 63

    def keyed(record: tuple) -> list[tuple]:
        user, session, kind, page, ts = record
        if not page or not all(x and number.match(x) for x in (user, session, ts)):
            return []
        u, s, t = int(user), int(session), int(ts)
        if not all(-limit <= x < limit for x in (u, s, t)):
            return []
        return [((u, s, t - t % width, t, page), ERROR_WORD in (kind or "").lower())]

    def folded(rows: Iterable[tuple]) -> Iterator[tuple]:
        for bucket, group in groupby(rows, key=lambda kv: kv[0][:3]):
            yield bucket, fragment(*fold_sorted(
                (t, page, page, error) for (_, _, _, t, page), error in group))

    n = SPREAD * records.getNumPartitions()
    return _routes(_sorted_by(records.flatMap(keyed), 3, n).mapPartitions(folded), n)


def top_pairs(pairs: RDD, n: int = DEFAULT_N) -> list[tuple[str, int]]:
    """Top ``n`` ``(route, count)`` of ``(route, 1)`` pairs; ``reduceByKey`` combines map-side."""
    return pairs.reduceByKey(add).takeOrdered(n, key=lambda kv: (-kv[1], kv[0]))


def top_routes_rdd(events: DataFrame, n: int = DEFAULT_N, seq: str | None = None,
                   width: int = BUCKET_SECONDS) -> list[tuple[str, int]]:
    """Top ``n`` ``(route, count)`` pairs."""
    return top_pairs(route_pairs_rdd(events, seq, width), n)


def top_routes_rdd_df(events: DataFrame, n: int = DEFAULT_N, seq: str | None = None,
                      width: int = BUCKET_SECONDS) -> DataFrame:
    """``top_routes_rdd`` as a DataFrame (``n`` rows at most)."""
    top = top_routes_rdd(events, n, seq, width)
    return events.sparkSession.createDataFrame(top, ROUTE_COUNTS_SCHEMA)


def top_routes_rdd_path(spark, path: str | list[str], n: int = DEFAULT_N, seq: str | None = None,
                        width: int = BUCKET_SECONDS) -> list[tuple[str, int]]:
    """The whole RDD pipeline from delimited files (Q7): text scan, parse, fold, count."""
    from ..sources.tsv import read_lines

    return top_routes_rdd(read_lines(spark, path, seq), n, seq, width)
