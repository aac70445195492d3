"""Command-line job: top routes of a clickstream file.

    python -m trailspark INPUT [--n 10] [--format tsv|parquet] [--seq COL]
                         [--form fold] [--json OUT] [--tsv OUT]
                         [--mode errorifexists] [--quote CHAR]

Reads tab-separated files with a header (or Parquet with the same columns),
prints the top ``n`` routes as ``route<TAB>count`` lines (escaped as in the
TSV sink) and, if asked, writes
them as one JSON object and/or TSV. Run it with ``spark-submit`` on a cluster;
``spark.checkpoint.dir`` should name a shared folder there.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import FORMS, all_route_counts, cast_events, read_events, top_n, tsv_lines, write_json, write_tsv
from .operators.counts import DEFAULT_N
from .plans import DEFAULT_FORM
from .schema import COUNT, ROUTE, ROUTE_COUNTS_SCHEMA


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="trailspark", description=__doc__.splitlines()[0])
    ap.add_argument("input", nargs="+", help="files or folders of events")
    ap.add_argument("--n", type=int, default=DEFAULT_N, help="how many routes (default 10)")
    ap.add_argument("--format", choices=("tsv", "parquet"), default="tsv",
                    help="tab-separated with a header (default), or Parquet")
    ap.add_argument("--seq", default=None, help="tie-break column inside one second")
    ap.add_argument("--form", choices=sorted(FORMS), default=DEFAULT_FORM,
                    help=f"physical plan (default {DEFAULT_FORM})")
    ap.add_argument("--json", help="write the top n as one JSON object here")
    ap.add_argument("--tsv", help="write the top n as route<TAB>count lines here")
    ap.add_argument("--mode", default="errorifexists", choices=("errorifexists", "overwrite"),
                    help="what to do if an output folder exists (default: fail)")
    ap.add_argument("--quote", default=None, help="quote character of the input ('' for none)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("trailspark").getOrCreate()
    if args.format == "tsv":
        events = read_events(spark, args.input, seq=args.seq, quote=args.quote)
    else:
        events = cast_events(spark.read.parquet(*args.input), seq=args.seq)
    counts = all_route_counts(events, form=args.form, seq=args.seq)
    # The pipeline runs once; the sinks get the n rows that it gave.
    rows = top_n(counts, args.n).collect()
    top = spark.createDataFrame(rows, ROUTE_COUNTS_SCHEMA)
    for line in tsv_lines(top.orderBy(F.desc(COUNT), F.asc(ROUTE))).collect():
        print(line["value"])
    if args.json:
        write_json(top, args.json, args.n, mode=args.mode)
    if args.tsv:
        write_tsv(top, args.tsv, args.n, mode=args.mode)


if __name__ == "__main__":
    main()
