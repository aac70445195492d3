"""Language-model scores: a smoothed trigram model of the training texts, sharded into tries.

Texts are cut into chunks of whole texts, each with its own small vocabulary.
Words are counted per hash bucket and get ids, frequent ones small ones, which
go back to the chunks. A chunk then sends every word that has a word before
it, as ``(before, last, word)`` with the texts it stands in, to the shard of
the last word. A shard so holds all of its contexts' counts and all lookups
for them: it counts the training texts, builds an Elias-Fano trie with
quantised Witten-Bell probabilities, writes it as one file to the shared
folder, maps the file, looks every distinct trigram up, and returns one sum
per text. One move of the words serves training and scoring.

A word that stands often enough to outgrow a shard is dealt out by the hash of
the word before it, a part for every ``part_words`` occurrences in the training
texts. Longer contexts are whole in a part; what follows the shorter one is added
up over the parts: each sends its distinct pairs ``(last, word)`` with their counts
to the place of the pair's class, and gets the totals and the number of kinds back.
So the sizes of parts and shards change no result. Equal trigrams of a text are
one entry, whatever their number.

With ``split`` the model itself has classes: the shorter context of a word is the
word and the hash class of the word before, a class for every ``split`` occurrences.

The first word of a text has no context and takes the word's own probability
``(c + 1) / (N + V + 1)``, which also ends every back-off; the second has one
word of context. Sums are whole numbers of quantisation steps, so results do
not depend on the order of addition.

Defined results: a null text is empty and has the end token only; a null id is
in training; without training texts every token has probability one; repeated
rows each count and each give their row; an empty table gives an empty result;
other columns are not read and may have any names.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailspark.runtime import remove_path, scratch_path

from .common import settled
from .elias_fano import STEPS, Trie, load, quantised, remove, save

#: Ids of the missing word before the second word of a text, and of the end token.
START, END, FIRST_ID = 0, 1, 2
#: Bytes of text to a chunk, and about how many words of chunks' vocabularies to a bucket
#: and trigrams to a shard. They bound what a task holds and change no result.
CHUNK_BYTES = 8 << 20
BUCKET_WORDS = 1 << 19
SHARD_WORDS = 1 << 19
#: Training texts are those whose id's CRC-32 leaves another remainder.
FOLDS, HELD_OUT = 7, 2
SEED = 12

CHUNKS = ("chunk long, texts binary, tokens binary, words binary, counts binary, n_words long, "
          "n_tokens long, train_texts long, train_tokens long")
PARTS = "place long, chunk long, kind int, data binary"
IDS = PARTS + ", most long"
#: Parts of a word whose pairs meet at one place.
MEET = 16
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers from 0 on, in bytes of equal weight side by side, compressed."""
    out = []
    for c in columns:
        width = max(1, (int(c.max(initial=0)).bit_length() + 7) // 8)
        planes = np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        out.append(len(c).to_bytes(8, "little") + bytes([width]) + planes.T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpacked(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n, width = int.from_bytes(raw[at:at + 8], "little"), raw[at + 8]
        planes = np.frombuffer(raw, np.uint8, n * width, at + 9).reshape(width, n)
        c = np.zeros((n, 8), np.uint8)
        c[:, :width] = planes.T
        out.append(c.view("<i8").ravel())
        at += 9 + n * width
    return out


def _joined(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def _split(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split()


def _hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))


def _held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def _numbering() -> dict[bytes, int]:
    """Numbers words from 0 as they are first looked up."""
    return defaultdict(count().__next__)


def _chunk(texts: list[tuple[int | None, list[bytes]]], number: int) -> dict:
    """A chunk's row: per text id (0 if null), flags (1 null id, 2 held out) and length;
    the tokens as places in the chunk's vocabulary; the words with their training counts."""
    names = _numbering()
    lengths = np.array([len(w) for _, w in texts], np.int64)
    tokens = np.fromiter(map(names.__getitem__, chain.from_iterable(w for _, w in texts)),
                         np.int64, int(lengths.sum()))
    # Frequent words get low places, which compress better.
    order = np.argsort(-np.bincount(tokens, minlength=len(names)), kind="stable")
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    tokens, words = place[tokens], list(names)
    held = np.array([_held_out(i) for i, _ in texts], bool)
    counts = np.bincount(tokens, np.repeat(~held, lengths), len(names)).astype(np.int64)
    ids = np.array([i or 0 for i, _ in texts], np.int64)
    flags = np.array([i is None for i, _ in texts], np.int64) | held.astype(np.int64) << 1
    return {"chunk": number, "texts": packed(ids.view(np.uint64), flags, lengths),
            "tokens": packed(tokens), "words": _joined([words[i] for i in order.tolist()]), "counts": packed(counts),
            "n_words": len(names), "n_tokens": len(tokens) + len(texts),
            "train_texts": int((~held).sum()), "train_tokens": int(lengths[~held].sum())}


def chunks(docs: DataFrame, doc_id: str, text: str, chunk_bytes: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(CHUNKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, list[bytes]]] = []
        size, number = 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_chunk(held, number)], schema=out)

        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                data = (t.as_py() or "").encode().lower()  # as bytes: A-Z only
                held.append((i.as_py(), data.split()))
                size += len(data) + 1
                if size >= chunk_bytes:
                    yield row()
                    held, size, number = [], 0, number + 1
        if held:
            yield row()

    return docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
                       docs[f"`{text}`"].alias("text")).mapInArrow(run, CHUNKS)


def _rows_of(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` one row at a time: ``fn`` gives some rows for each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                got = fn(batch.slice(k, 1).to_pylist()[0])
                if got:
                    yield pa.RecordBatch.from_pylist(got, schema=out)

    return df.mapInArrow(run, schema)


def word_ids(table: DataFrame, buckets: int) -> DataFrame:
    """Per chunk and bucket of words: ``place`` (the bucket), ``chunk``, the words' ids and
    training counts in the chunk's order; ``kind`` is on one row of a bucket the number of
    its words that training holds, else 0, and ``most`` the greatest training count."""
    def scatter(row: dict) -> list[dict]:
        words, counts = _split(row["words"]), unpacked(row["counts"])[0]
        if not words:  # empty texts only
            return []
        bucket = (_hashes(words) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        found, first = np.unique(bucket[order], return_index=True)
        out = []
        for b, at in zip(found.tolist(), np.split(order, first[1:]), strict=True):
            mine = _joined([words[i] for i in at.tolist()])
            data = len(mine).to_bytes(8, "little") + mine + packed(counts[at])
            out.append({"place": b, "chunk": row["chunk"], "kind": 0, "data": data})
        return out

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        names, total, held = _numbering(), np.zeros(0, np.int64), []
        for data in rows["data"]:
            n = int.from_bytes(data[:8], "little")
            words = _split(data[8:8 + n])
            mine = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
            if len(names) > len(total):
                total = np.concatenate([total, np.zeros(max(len(total), len(names)), np.int64)])
            total[mine] += unpacked(data[8 + n:])[0]  # a word is once in a row
            held.append(mine)
        total = total[:len(names)]
        ids = np.empty(len(total), np.int64)
        ids[np.argsort(-total, kind="stable")] = (
            FIRST_ID + int(rows["place"].iloc[0]) + np.arange(len(total)) * buckets)
        return pd.DataFrame({
            "place": rows["place"], "chunk": rows["chunk"],
            "kind": [int((total > 0).sum())] + [0] * (len(held) - 1),
            "data": [packed(ids[mine], total[mine]) for mine in held],
            "most": int(total.max(initial=0))})

    return (_rows_of(table.select("chunk", "words", "counts"), scatter, PARTS)
            .groupBy("place").applyInPandas(number, IDS))


class _Corpus:
    """Totals that every task needs: a few numbers."""

    def __init__(self, totals, known: int, buckets: int, shard_words: int, split: int | None,
                 part_words: int, most: int):
        self.texts = totals["train_texts"] or 0
        self.tokens = (totals["train_tokens"] or 0) + self.texts
        self.types = known + (self.texts > 0)
        self.buckets, self.split, self.part_words = buckets, split, part_words
        self.parted = split is None and most > part_words
        self.shards = max(1, math.ceil((totals["n_tokens"] or 0) / shard_words))
        self.log_all = math.log10(self.tokens + self.types + 1)

    def log10p(self, count: np.ndarray) -> np.ndarray:
        return np.log10(count + 1.0) - self.log_all


def _trigrams(row: dict, replies: list[dict], c: _Corpus) -> list[dict]:
    """A chunk's rows: its texts with base scores (kind 0), and entries for the shards (kind 1)."""
    ids, flags, lengths = unpacked(row["texts"])
    tokens = unpacked(row["tokens"])[0]
    hashes = _hashes(_split(row["words"]))
    n = len(hashes)
    names, counts = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    order = np.argsort((hashes % np.uint64(c.buckets)).astype(np.int64), kind="stable")
    at = 0
    for r in sorted(replies, key=lambda r: r["place"]):
        name, count = unpacked(r["data"])
        mine = order[at:at + len(name)]
        names[mine], counts[mine], at = name, count, at + len(name)
    names[n], counts[n] = END, c.texts  # place n of the vocabulary is the end token
    log10p = c.log10p(counts)
    code1 = quantised(log10p).astype(np.int64)

    # Every text's tokens with its end.
    many = lengths + 1
    ends = np.cumsum(many) - 1
    w = np.full(int(many.sum()), n, np.int64)
    text = np.repeat(np.arange(len(many)), many)
    body = np.ones(len(w), bool)
    body[ends] = False
    w[body] = tokens
    base = np.bincount(text, log10p[w], len(many))
    known = np.bincount(text, counts[w] > 0, len(many)).astype(np.int64)
    first = ends - lengths
    out = [{"place": c.shards + row["chunk"], "chunk": row["chunk"], "kind": 0,
            "data": b"".join((len(x).to_bytes(8, "little") + x) for x in (
                packed(ids.view(np.uint64), flags, many, known, code1[w[first]]),
                base.tobytes()))}]

    later = np.ones(len(w), bool)
    later[first] = False
    i = np.flatnonzero(later)
    if len(i):
        last, word, doc = w[i - 1], w[i], text[i]
        before = np.where(i - first[doc] >= 2, w[np.maximum(i - 2, 0)], n)
        hashes = np.append(hashes, np.uint64(0))
        classes = np.maximum(1, -(-counts // (c.split or c.part_words)))
        part = (hashes[before] % classes[last].astype(np.uint64)).astype(np.int64)
        mixed = (hashes[last] ^ (part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        if c.split is None:  # a place in the shards only; the entry has the word's count
            part = counts[last]
        shard = ((mixed >> np.uint64(7)) % np.uint64(c.shards)).astype(np.int64)
        del mixed, i, w, text, body, later
        # Equal trigrams of a text are one entry with a number; entries go by the last word's
        # id. Texts rise already, and the sort is stable.
        by_id = np.empty(n + 1, np.int64)
        by_id[np.argsort(names)] = np.arange(n + 1)
        k1, k2 = shard * (n + 1) + by_id[last], before * (n + 1) + word
        if c.shards * (n + 1) ** 3 < 1 << 63:
            order = np.argsort(k1 * (n + 1) ** 2 + k2, kind="stable")
        else:
            order = np.lexsort((k2, k1))
        k1, k2 = k1[order], k2[order]
        doc = doc[order]
        new = np.ones(len(order), bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(order)))
        order, doc = order[at], doc[at]
        del k1, k2, new, at
        shard, last, part, before, word = (x[order] for x in (shard, last, part, before, word))
        held = flags[doc] >> 1
        before = np.where(before == n, START, names[before])
        last = names[last]
        places, starts = np.unique(shard, return_index=True)
        stops = np.append(starts[1:], len(shard))
        for s, a, b in zip(places.tolist(), starts.tolist(), stops.tolist(), strict=True):
            x = slice(a, b)
            # A part's words are listed once, with what they have without context.
            ids_, one, of = np.unique(names[word[x]], return_index=True, return_inverse=True)
            out.append({"place": s, "chunk": row["chunk"], "kind": 1, "data": packed(
                np.diff(ids_, prepend=0), code1[word[x][one]],
                np.diff(last[x], prepend=0), part[x], before[x], of,
                doc[x] << 1 | held[x], times[x])})
    return out


def _entries(rows: pd.DataFrame) -> tuple[list[int], list[np.ndarray]]:
    """A shard's rows as columns, and the length of each."""
    columns = []
    for d in rows["data"]:
        ids, code, last, part, before, of, doc, times = unpacked(d)
        columns.append((np.cumsum(last), part, before, np.cumsum(ids)[of], code[of], doc, times))
    return [len(x[0]) for x in columns], [np.concatenate(x) for x in zip(*columns, strict=True)]


class _Parted:
    """The pairs of a shard whose words are dealt out in parts, by the places where they meet.

    Both readings of a shard make the same pairs in the same order, whatever the order of
    its rows."""

    def __init__(self, last, total, word, doc, times, c: _Corpus):
        mine = np.flatnonzero(total > c.part_words)
        count = np.where(doc[mine] & 1, 0, times[mine])
        self.key, self.word, self.count, _ = Trie.pairs(last[mine], word[mine], count)
        self.lasts, at = np.unique(last[mine], return_index=True)
        self.seen = total[mine][at]
        places = -(-self.seen // (c.part_words * MEET))
        first = (self.lasts * 0x9E3779B1 >> 7) % c.shards
        of = np.searchsorted(self.lasts, self.key)
        self.place = (first[of] + (self.word * 0x85EBCA6B >> 9) % places[of]) % c.shards
        # Every place of a word hears from every shard that has it.
        each = np.repeat(np.arange(len(self.lasts)), places)
        step = np.arange(len(each)) - np.repeat(np.cumsum(places) - places, places)
        met = np.unique(((first[each] + step) % c.shards) * max(1, len(self.lasts)) + each)
        self.met_place, self.met = met // max(1, len(self.lasts)), met % max(1, len(self.lasts))
        self.order = np.lexsort((self.word, self.key, self.place))

    def at_places(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per place, rising: the numbers of its words, and of its pairs."""
        place = self.place[self.order]
        for p in np.unique(self.met_place).tolist():
            a, b = np.searchsorted(self.met_place, [p, p + 1])
            x, y = np.searchsorted(place, [p, p + 1])
            yield p, self.met[a:b], self.order[x:y]


def _asked(rows: pd.DataFrame, c: _Corpus) -> pd.DataFrame:
    """A shard's pairs of parted words, a row for each place; ``chunk`` is the shard."""
    out = []
    if rows["kind"].iloc[0] == 1:
        _, (last, total, _, word, _, doc, times) = _entries(rows)
        mine = _Parted(last, total, word, doc, times, c)
        for place, words, pairs in mine.at_places():
            out.append({"place": place, "chunk": int(rows["place"].iloc[0]), "kind": 2, "data": packed(
                mine.lasts[words], np.searchsorted(mine.lasts[words], mine.key[pairs]),
                mine.word[pairs], mine.count[pairs])})
    return pd.DataFrame(out, columns=["place", "chunk", "kind", "data"])


def _answered(rows: pd.DataFrame) -> pd.DataFrame:
    """What a place was asked: per word the number of kinds that follow it here in training,
    and per pair its count in all parts."""
    asked = [unpacked(d) for d in rows["data"]]
    key = np.concatenate([lasts[of] for lasts, of, _, _ in asked])
    pair_key, _, total, of = Trie.pairs(key, np.concatenate([x[2] for x in asked]),
                                        np.concatenate([x[3] for x in asked]))
    known, kinds = np.unique(pair_key[total > 0], return_counts=True)
    out, at = [], 0
    for lasts, *_, count in asked:
        place = np.searchsorted(known, lasts)
        here = np.append(known, -1)[place] == lasts
        out.append(packed(np.where(here, np.append(kinds, 0)[place], 0), total[of[at:at + len(count)]]))
        at += len(count)
    return pd.DataFrame({"place": rows["chunk"], "chunk": rows["place"], "kind": 2, "data": out})


def _shard(rows: pd.DataFrame, folder: str, c: _Corpus, answers: pd.DataFrame | None = None) -> pd.DataFrame:
    """One shard: count, build the trie, map it, and sum each text's steps."""
    sizes, (last, part, before, word, code1, doc, times) = _entries(rows)
    parted = None
    if answers is not None and len(answers):
        parted = _Parted(last, part, word, doc, times, c)
        seen, kinds1 = parted.seen, np.zeros(len(parted.lasts), np.int64)
        told = dict(zip(answers["chunk"].tolist(), answers["data"], strict=True))
        for place, words_, pairs in parted.at_places():
            k, t = unpacked(told[place])
            kinds1[words_] += k
            parted.count[pairs] = t
    if c.split is None:
        part = np.zeros(len(part), np.int64)
    train = (doc & 1) == 0
    classes = int(part.max(initial=0)) + 1
    # Dense ranks of the three columns make one key of a trigram.
    keys, key = np.unique(last * classes + part, return_inverse=True)
    befores, b = np.unique(before, return_inverse=True)
    words, at, w = np.unique(word, return_index=True, return_inverse=True)
    code_of = code1[at]
    whole = (key * len(befores) + b) * len(words) + w
    kinds, of = np.unique(whole, return_inverse=True)
    count = np.bincount(of, np.where(train, times, 0), len(kinds)).astype(np.int64)
    w = kinds % len(words)
    key, b = keys[kinds // len(words) // len(befores)], befores[kinds // len(words) % len(befores)]
    code = code_of[w]
    w = words[w]
    t = count > 0
    steps = code.astype(np.int64)
    follow = None
    if parted is not None:
        pair_key, pair_word, pair_count, _ = Trie.pairs(key[t], w[t], count[t])
        own = ~np.isin(pair_key, parted.lasts)
        met = parted.count > 0
        pair_key = np.concatenate([pair_key[own], parted.key[met]])
        order = np.lexsort((np.concatenate([pair_word[own], parted.word[met]]), pair_key))
        pair_key = pair_key[order]
        pair_word = np.concatenate([pair_word[own], parted.word[met]])[order]
        pair_count = np.concatenate([pair_count[own], parted.count[met]])[order]
        contexts, one = np.unique(pair_key, return_inverse=True)
        seen1 = np.bincount(one, pair_count, len(contexts)).astype(np.int64)
        t1 = np.bincount(one, minlength=len(contexts))
        at = np.searchsorted(contexts, parted.lasts)
        has = np.append(contexts, -1)[at] == parted.lasts
        seen1[at[has]], t1[at[has]] = seen[has], kinds1[has]
        p1 = 10.0 ** (-code_of[np.searchsorted(words, pair_word)] / STEPS)
        follow = (pair_key, pair_word, pair_count, p1, seen1, t1)
    if t.any() or follow is not None and len(follow[0]):
        uri = f"{folder}/trie-{int(rows['place'].iloc[0])}-{uuid.uuid4().hex}"
        save(Trie.build(key[t], b[t], w[t], count[t], 10.0 ** (-code[t] / STEPS), follow), uri)
        try:
            steps = Trie(load(uri)).codes(key, b, w, code)
        finally:
            remove(uri)
    sums = steps[of] * times
    out, at = [], 0
    for n in sizes:
        texts, first = np.unique(doc[at:at + n] >> 1, return_inverse=True)
        out.append(packed(texts, np.bincount(first, sums[at:at + n]).astype(np.int64)))
        at += n
    return pd.DataFrame({"place": rows["place"], "chunk": rows["chunk"], "kind": 1, "data": out})


def _scores(rows: pd.DataFrame, c: _Corpus) -> pd.DataFrame:
    """A chunk's texts with all their sums."""
    data = rows["data"][rows["kind"] == 0].iloc[0]
    n = int.from_bytes(data[:8], "little")
    ids, flags, many, known, steps = unpacked(data[8:8 + n])
    base = np.frombuffer(data, float, -1, 16 + n)
    steps = steps.copy()
    for part in rows["data"][rows["kind"] == 1]:
        texts, sums = unpacked(part)
        steps[texts] += sums
    doc_id = pd.array(ids, "Int64")
    doc_id[(flags & 1) == 1] = pd.NA
    return pd.DataFrame({
        "doc_id": doc_id, "held_out": flags >> 1 == 1, "n_tokens": many, "n_known": known,
        "train_tokens": c.tokens, "base_score": base + 0.0, "score": -steps / STEPS + 0.0})


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS,
              shard_words: int = SHARD_WORDS, split: int | None = None,
              part_words: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    The model is trained and all rows are scored when this is called; the
    result is in the shared checkpoint folder, and the working tables are removed.
    """
    spark = docs.sparkSession
    work = scratch_path(spark, "lm")
    if "://" not in work and ":/" in work:  # file:/folder, as Hadoop writes it
        work = work.replace(":/", ":///", 1)
    elif ":" not in work:
        work = f"file://{work}"
    try:
        chunks(docs, doc_id, text, chunk_bytes).write.parquet(f"{work}/chunks")
        table = spark.read.parquet(f"{work}/chunks")
        totals = table.agg(*[F.sum(c).alias(c) for c in (
            "n_words", "n_tokens", "train_texts", "train_tokens")]).first()
        buckets = max(1, math.ceil((totals["n_words"] or 0) / bucket_words))
        word_ids(table, buckets).write.parquet(f"{work}/ids")
        ids = spark.read.parquet(f"{work}/ids")
        known = ids.agg(F.sum("kind").alias("n"), F.max("most").alias("most")).first()
        corpus = _Corpus(totals, known["n"] or 0, buckets, shard_words, split,
                         part_words or max(1, shard_words // 4), known["most"] or 0)

        def spread(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(_trigrams(left.iloc[0].to_dict(), right.to_dict("records"), corpus))

        entries = (table.select("chunk", "texts", "tokens", "words").groupBy("chunk")
                   .cogroup(ids.groupBy("chunk")).applyInPandas(spread, PARTS))
        folder = f"{work}/tries"
        _make_folder(spark, folder)

        def shard(rows: pd.DataFrame, answers: pd.DataFrame | None = None) -> pd.DataFrame:
            return rows if rows["kind"].iloc[0] == 0 else _shard(rows, folder, corpus, answers)

        places = entries.groupBy("place")
        if corpus.parted:
            answers = (places.applyInPandas(lambda rows: _asked(rows, corpus), PARTS)
                       .groupBy("place").applyInPandas(_answered, PARTS))
            sums = places.cogroup(answers.groupBy("place")).applyInPandas(shard, PARTS)
        else:
            sums = places.applyInPandas(lambda rows: shard(rows), PARTS)
        return settled(
            sums.groupBy("chunk").applyInPandas(lambda rows: _scores(rows, corpus), SCORES))
    finally:
        remove_path(spark, work)


def _make_folder(spark, path: str) -> None:
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(target)
