"""Small tables for the training-data operators: edge rows, clashing columns, fixed prose."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use inside.
CLASH = {
    "row": "'r'", "fp": "1L", "size": "2", "kept": "false", "g": "'g'", "id": "'i'", "w": "array(1)",
    "key": "'k'", "keys": "'k'", "text_hash": "3L", "h": "4L", "bucket": "5", "digest": "'d'",
    "spans": "'s'", "record": "'q'", "copies": "6", "root": "7L", "value": "8L", "lines": "'l'",
    "x1": "0L", "n_words": "9", "place": "1", "refers_to": "2L", "component_id": "3L",
}
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar".split()


def prose(n_words: int, seed: int, width: int = 12) -> str:
    """Invented words from a seed, a line feed every ``width`` words."""
    rng = random.Random(seed)
    out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n_words)]
    return "\n".join(" ".join(out[i:i + width]) for i in range(0, n_words, width))


def edge_docs() -> list[tuple]:
    """Nulls in every column, empty and very long texts, repeated rows, copies, ties."""
    same, long = prose(60, 1), prose(20_000, 2)
    return [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", "de", None, 4),
        (None, prose(40, 3), "en", "b", 9), (None, None, None, None, None),
        (5, long, "en", "b", len(long)), (6, same, "en", "a", 1), (6, same, "en", "a", 1),
        (7, same, "fr", "b", 1), (8, prose(80, 4), None, "b", 1), (9, "one", "en", "c", 3),
        (10, "Two words", "en", "c", 9), (11, "ÀÉ x ٥ \U0001f600 z", "en", "é", 9),
    ]


def frame(spark: SparkSession, rows: list[tuple], schema: str = DOCS, clash: bool = False) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    if clash:
        names = {c: e for c, e in CLASH.items() if c not in df.columns}
        df = df.selectExpr("*", *[f"{e} AS `{c}`" for c, e in names.items()])
    return df


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
