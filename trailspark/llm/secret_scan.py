"""Secret scan with corpus-wide ownership frequency.

Base patterns find candidate spans in every whole text, and a wider pattern
adds long mixed tokens. Every candidate value is hashed; over the whole corpus
the distinct repositories and owners that hold a hash are counted. Each span
then is of one class: ``copied``, an example that several owners hold; ``live``,
held by few and random-looking; ``plain``, held by few and not random. Wider
candidates become spans only if they are live; base spans always stay.

With ``widely`` (as the query runs), a copied example is a value that many owners
and many repositories hold, and texts that are near copies (SimHash, see
``simhash``) count once, by their first holder, so a document copied under other
owners does not turn its values into examples. Random wider candidates then
stay as spans, copied ones too.

Defined results: a null or empty text holds no span; null owners and
repositories count as one of their own; repeated rows hold the same spans and
count once; an empty table gives an empty result; input columns may have any
names.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from itertools import accumulate

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_part, map_rows, settled
from .simhash import classes, fingerprint

#: The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "token")
CLASSES = ("copied", "live", "plain")
MIN_ASSIGN, MIN_ACCESS = 6, 20
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: The wider pattern: long runs that mix cases and digits.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{32,}(?![A-Za-z0-9+/_=-])")
MIN_ENTROPY = 3.0
#: Distinct owners from which a value counts as a copied example.
MANY_OWNERS = 2
#: Distinct owners and repositories from which a value is widely held; both are needed.
WIDE_OWNERS, WIDE_REPOS = 4, 8


def entropy(value: str) -> float:
    """Shannon entropy in bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in map(value.count, set(value)))


def candidates(text: str | None) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, value)`` of base and wider candidates, by start, then kind."""
    text = text or ""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)
                  if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    taken = sorted((s, e) for s, _, e, _ in found)
    starts = [s for s, _ in taken]
    furthest = [0, *accumulate((e for _, e in taken), max)]  # end of the first k spans
    for m in TOKEN.finditer(text):
        v = m[0]
        mixed = any(c.isdigit() for c in v) and any(c.isupper() for c in v) and any(
            c.islower() for c in v)
        if mixed and furthest[bisect_left(starts, m.end())] <= m.start():
            found.append((m.start(), 3, m.end(), v))
    return sorted(found)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: str = "doc_id",
         owner: str = "source") -> DataFrame:
    """Per row: ``doc_id, repo, owner``, its candidates with value hash and randomness, and,
    if it has any, the text's SimHash ``fp``."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        spans = []
        for t in rows["text"]:
            spans.append([
                {"start": s, "kind": k, "end": e,
                 "value": xxhash.xxh64_intdigest(v.encode(), 42) - (1 << 63),
                 "random": entropy(v) >= MIN_ENTROPY}
                for s, k, e, v in candidates(t)])
        return {"doc_id": rows["doc_id"], "repo": rows["repo"], "owner": rows["owner"],
                "fp": [fingerprint(t) if found else None
                       for t, found in zip(rows["text"], spans, strict=True)],
                "spans": spans}

    picked = docs.select(
        docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].alias("text"),
        key_part(docs[f"`{repo}`"]).alias("repo"), key_part(docs[f"`{owner}`"]).alias("owner"))
    return map_rows(
        picked, run, "doc_id long, repo string, owner string, fp long, "
        "spans array<struct<start:int,kind:int,end:int,value:long,random:boolean>>")


def ownership(found: DataFrame, once: bool = False) -> DataFrame:
    """``(value, repos, owners)``: distinct repositories and owners of every candidate value.

    ``once``: of the holders of near copies, only the least owner and repository counts.

    Each level is summed before its shuffle, so a value that a third of all
    texts hold is one row a task.
    """
    if once:
        of = classes(found.select("fp", "doc_id")).select("fp", "root")
        least = F.min(F.struct("owner", "repo")).alias("holder")
        values = (  # equal fingerprints first: as many rows as there are classes go on
            found.select("repo", "owner", "fp", F.explode("spans.value").alias("value"))
            .groupBy("value", "fp").agg(least).join(of, "fp")
            .select("value", "root", "holder.owner", "holder.repo")
            .groupBy("value", "root").agg(least)
            .select("value", "holder.owner", "holder.repo"))
    else:
        values = found.select("repo", "owner", F.explode("spans.value").alias("value"))
    return (values.groupBy("value", "owner", "repo").agg(F.lit(1).alias("one"))
            .groupBy("value", "owner").agg(F.sum("one").alias("repos"))
            .groupBy("value").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners")))


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: str = "doc_id",
            owner: str = "source", widely: bool = False) -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, each with kind, place, class and holders."""
    copied = F.col("owners") >= MANY_OWNERS
    if widely:
        copied = (F.col("owners") >= WIDE_OWNERS) & (F.col("repos") >= WIDE_REPOS)
    found = settled(scan(docs, doc_id, text, repo, owner)
                    .withColumn("row", F.monotonically_increasing_id()))
    none = found.where(F.size("spans") == 0)
    hits = found.where(F.size("spans") > 0)
    one = hits.select("row", "doc_id", F.explode("spans").alias("s")).select(
        "row", "doc_id", "s.*")
    judged = (
        one.join(settled(ownership(hits, once=widely)), "value")
        .withColumn("class", F.when(copied, "copied").when(F.col("random"), "live")
                    .otherwise("plain"))
        .where((F.col("kind") < KINDS.index("token"))
               | (F.col("random") if widely else F.col("class") == "live"))
        .select("row", F.struct("start", "kind", "end", "class", "owners", "repos").alias("s"))
        .groupBy("row").agg(F.sort_array(F.collect_list("s")).alias("judged")))
    kind = "array<struct<start:int,kind:int,end:int,class:string,owners:bigint,repos:bigint>>"
    return (
        hits.join(judged, "row", "left")
        .select("doc_id", F.coalesce("judged", F.array().cast(kind)).alias("spans"))
        .unionByName(none.select("doc_id", F.array().cast(kind).alias("spans"))))


def secret_report(docs: DataFrame, **kw) -> DataFrame:
    """Per row: base counts, digest of the base spans, all spans, and how many are of each class.

    ``classes``, ``owners`` and ``repos`` are those of the spans, in the order of ``spans``.
    """
    found = secrets(docs, **kw)
    name = F.array(*map(F.lit, KINDS))
    text = lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    of_class = lambda c: F.size(F.filter("spans", lambda s: s["class"] == c)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("token"))
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        *[of_class(c).alias(f"n_{c}") for c in CLASSES],
        F.transform("spans", lambda s: s["class"]).alias("classes"),
        F.transform("spans", lambda s: s["owners"]).alias("owners"),
        F.transform("spans", lambda s: s["repos"]).alias("repos"))


def base_digest(text: str | None) -> str:
    """The base digest of one text, straight from its definition (for tests)."""
    spans = [(s, k, e) for s, k, e, _ in candidates(text) if k < KINDS.index("token")]
    return hashlib.sha256(
        ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
