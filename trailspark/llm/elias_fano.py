"""Elias-Fano sequences and an n-gram trie made of them, in one memory-mapped file.

An ``EliasFano`` holds a rising sequence: the low bits of every value packed,
the high bits in unary, with a count of ones per word as directory. Access and
successor search take vectors of arguments.

A ``Trie`` has four levels. ``contexts`` are the keys of last words;
``follow`` holds, for each, the words seen after it; ``longer`` the words seen
before it, which make the longer contexts; ``follow2`` what was seen after
those. A level is one rising sequence: the entries of a range are stored
relative to a base, the end of the range before, and a lookup is a successor
search for base plus key. In ``follow2`` a word is not its id but its place
among the words that follow the shorter context, so the numbers stay small.
Probabilities and back-off weights are whole steps of 1/STEPS of a decade.
"""

from __future__ import annotations

import json
import mmap

import numpy as np
import pyarrow.fs as pafs

STEPS = 4096
_ONE = np.uint64(1)


def quantised(log10p: np.ndarray) -> np.ndarray:
    """Whole steps of minus ``log10p``, 16 decades at most."""
    return np.clip(np.rint(-log10p * STEPS), 0, 65535).astype(np.uint16)


#: A set bit's place is found by halving.
_HALVES = (32, 16, 8, 4, 2, 1)


def _select(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the set bit number ``r`` (from 0) in each 64-bit word."""
    r, place = r.astype(np.uint8), np.zeros(len(word), np.uint8)
    for half in _HALVES:
        low = np.bitwise_count(word & np.uint64((1 << half) - 1))
        up = (r >= low).view(np.uint8)
        r -= low * up
        up *= np.uint8(half)
        place += up
        word = word >> up.astype(np.uint64)
    return place.astype(np.int64)


class EliasFano:
    """A rising sequence of integers from 0 on, as arrays that can live in a mapped file."""

    FIELDS = ("meta", "low", "high", "ones")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.n, self.bits = (int(x) for x in arrays["meta"])
        self.low, self.high, self.ones = arrays["low"], arrays["high"], arrays["ones"]

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        # Low bits, side by side in 64-bit words; one spare word to read across.
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            part = (values & ((1 << bits) - 1)).astype(np.uint64)
            at = np.arange(n) * bits
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = (at & 63) + bits > 64
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        places = (values >> bits) + np.arange(n)
        high = np.zeros((int(places[-1]) if n else 0) // 64 + 2, np.uint64)
        np.bitwise_or.at(high, places >> 6, _ONE << (places & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        return cls({"meta": np.array([n, bits], np.int64), "low": low, "high": high,
                    "ones": ones.astype(np.uint32 if n < 1 << 32 else np.uint64)})

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        both = (self.low[word] >> shift) | np.where(
            shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (both & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), "right") - 1
        place = word * 64 + _select(self.high[word], i - self.ones[word].astype(np.int64))
        return ((place - i) << self.bits) | self._low(i)

    def _bucket(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the places whose values have high bits ``h``: the ones between
        zeros number ``h - 1`` and ``h``."""
        zeros = np.arange(len(self.ones)) * 64 - self.ones.astype(np.int64)

        def ahead(z: np.ndarray) -> np.ndarray:  # the bit after zero number z
            word = np.searchsorted(zeros, z, "right") - 1
            return word * 64 + _select(~self.high[word], z - zeros[word]) + 1

        lo, hi = np.full(len(h), self.n), np.full(len(h), self.n)
        inside = np.flatnonzero(h < zeros[-1])
        h = h[inside]
        bit = np.zeros(len(h), np.int64)
        later = np.flatnonzero(h > 0)
        bit[later] = ahead(h[later] - 1)
        lo[inside] = bit - h
        # The next zero mostly is in the same word.
        free = ~self.high[bit >> 6] >> (bit & 63).astype(np.uint64)
        run = np.bitwise_count((free & (~free + _ONE)) - _ONE).astype(np.int64)
        far = np.flatnonzero(free == 0)
        run[far] = ahead(h[far]) - 1 - bit[far]
        hi[inside] = bit + run - h
        return lo, hi

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first value that is not below each ``x`` (the length if there is
        none), and whether it is ``x``."""
        lo, top = self._bucket(x >> self.bits)
        hi = top.copy()
        want = x & ((1 << self.bits) - 1)
        live = np.flatnonzero(lo < hi)
        while len(live):  # halve the bucket of equal high bits
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < want[live]
            lo[live] = np.where(less, mid + 1, lo[live])
            hi[live] = np.where(less, hi[live], mid)
            live = live[lo[live] < hi[live]]
        same = lo < top
        inside = np.flatnonzero(same)
        same[inside] = self._low(lo[inside]) == want[inside]
        return lo, same

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is not below ``x``; the length if there is none."""
        return self.find(x)[0]


def _relative(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Keys that rise within ranges, made one rising sequence: plus the end of the range before."""
    if not len(keys):
        return keys
    end = begin[1:]
    full = np.flatnonzero(end > begin[:-1])
    last = keys[end[full] - 1] + 1
    base = np.zeros(len(begin) - 1, np.int64)
    base[full] = np.cumsum(last) - last
    return keys + np.repeat(base, np.diff(begin))


class Trie:
    """Smoothed probabilities of words after contexts of one and two words."""

    SEQUENCES = ("contexts", "follow", "longer", "follow2", "to_follow", "to_longer", "to_follow2")
    CODES = ("back", "prob", "back2", "prob2")

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name in self.SEQUENCES:
            setattr(self, name, EliasFano({f: arrays[f"{name}.{f}"] for f in EliasFano.FIELDS}))
        for name in self.CODES:
            setattr(self, name, arrays[name])

    @staticmethod
    def pairs(key: np.ndarray, word: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct ``(key, word)`` in order, their counts, and each argument's place among them."""
        order = np.lexsort((word, key))
        new = np.ones(len(key), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (word[order][1:] != word[order][:-1])
        first = np.flatnonzero(new)
        of = np.empty(len(key), np.int64)
        of[order] = np.cumsum(new) - 1
        total = np.add.reduceat(count[order], first) if len(first) else np.zeros(0, np.int64)
        return key[order][first], word[order][first], total, of

    @staticmethod
    def build(key: np.ndarray, before: np.ndarray, word: np.ndarray, count: np.ndarray,
              p1: np.ndarray, whole: tuple[np.ndarray, ...] | None = None) -> dict[str, np.ndarray]:
        """The levels from distinct ``(key, before, word)``, sorted so, with counts and the
        words' own probabilities.

        Witten-Bell smoothing: a context seen ``c`` times before ``t`` different words
        leaves ``t / (c + t)`` to the next shorter one.

        ``whole`` has what follows the keys where the trigrams are a part of it only: distinct
        ``(key, word)`` in order, counts, words' own probabilities, and per distinct key its
        ``c`` and ``t``. It may hold more pairs than the trigrams do.
        """
        def starts(*cols: np.ndarray) -> np.ndarray:
            new = np.zeros(len(key), bool)
            new[:1] = True
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            return np.flatnonzero(new)

        def total(x: np.ndarray, first: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, first) if len(first) else np.zeros(0, np.int64)

        if whole is None:
            pair_key, pair_word, c12, pair_of = Trie.pairs(key, word, count)
            lower = np.empty(len(c12))
            lower[pair_of] = p1
            contexts, pair_at1 = np.unique(pair_key, return_inverse=True)
            kinds1 = np.bincount(pair_at1, minlength=len(contexts))
            seen1 = np.bincount(pair_at1, c12, len(contexts)).astype(np.int64)
        else:
            pair_key, pair_word, c12, lower, seen1, kinds1 = whole
            contexts, pair_at1 = np.unique(pair_key, return_inverse=True)
            words, w = np.unique(pair_word, return_inverse=True)
            pair_of = np.searchsorted(
                pair_at1 * len(words) + w,
                np.searchsorted(contexts, key) * len(words) + np.searchsorted(words, word))
        at1 = np.searchsorted(contexts, key)
        first2 = starts(key, before)
        # What follows each context, whatever came before it.
        p2 = (c12 + kinds1[pair_at1] * lower) / (seen1 + kinds1)[pair_at1]
        seen2, kinds2 = total(count, first2), np.diff(np.append(first2, len(key)))
        at2 = np.repeat(np.arange(len(first2)), kinds2)
        p3 = (count + kinds2[at2] * p2[pair_of]) / (seen2 + kinds2)[at2]

        to_follow = np.searchsorted(pair_at1, np.arange(len(contexts) + 1))
        to_longer = np.searchsorted(at1[first2], np.arange(len(contexts) + 1))
        to_follow2 = np.append(first2, len(key))
        sequences = {
            "contexts": contexts, "to_follow": to_follow, "to_longer": to_longer,
            "to_follow2": to_follow2,
            "follow": _relative(pair_word, to_follow),
            "longer": _relative(before[first2], to_longer),
            "follow2": _relative(pair_of - to_follow[at1], to_follow2)}
        out = {f"{name}.{f}": a for name, values in sequences.items()
               for f, a in EliasFano.build(values).arrays.items()}
        return out | {"back": quantised(np.log10(kinds1 / (seen1 + kinds1))),
                      "prob": quantised(np.log10(p2)),
                      "back2": quantised(np.log10(kinds2 / (seen2 + kinds2))),
                      "prob2": quantised(np.log10(p3))}

    @staticmethod
    def _ranges(level: EliasFano, pointers: EliasFano, at: np.ndarray,
                known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and base of the ranges of entries ``at``; empty ones where not known."""
        begin, end, base = (np.zeros(len(at), np.int64) for _ in range(3))
        i = np.flatnonzero(known)
        begin[i], end[i] = pointers.at(at[i]), pointers.at(at[i] + 1)
        later = np.flatnonzero((begin > 0) & (end > begin))
        base[later] = level.at(begin[later] - 1) + 1
        end[end == begin] = 0  # nothing is below it
        return begin, end, base

    def codes(self, key: np.ndarray, before: np.ndarray, word: np.ndarray,
              code1: np.ndarray) -> np.ndarray:
        """Steps of minus log10 of each word's probability after its context; ``code1`` is
        what the word has without one. Neighbours with equal contexts share their lookups,
        so sorted arguments are the fastest."""
        out = code1.astype(np.int64)
        if not len(key):
            return out
        new1 = np.append(True, key[1:] != key[:-1])
        new2 = new1 | np.append(True, before[1:] != before[:-1])
        of1, of2 = np.cumsum(new1) - 1, np.cumsum(new2) - 1
        at1, known1 = self.contexts.find(key[new1])
        begin, end, base = self._ranges(self.follow, self.to_follow, at1, known1)
        _, last, start = self._ranges(self.longer, self.to_longer, at1, known1)
        back = np.zeros(len(at1), np.int64)
        back[known1] = self.back[at1[known1]]
        # The longer contexts.
        one = of1[new2]
        at2, known2 = self.longer.find(start[one] + before[new2])
        known2 &= at2 < last[one]
        _, end2, base2 = self._ranges(self.follow2, self.to_follow2, at2, known2)
        back2 = np.zeros(len(at2), np.int64)
        back2[known2] = self.back2[at2[known2]]
        # The words after the short context, and their places among what follows the long one.
        pair, met = self.follow.find(base[of1] + word)
        met &= pair < end[of1]
        out += np.where(met, 0, back[of1]) + back2[of2]
        out[met] += self.prob[pair[met]].astype(np.int64) - code1[met]
        two = np.flatnonzero(met & known2[of2])
        place, whole = self.follow2.find(base2[of2[two]] + pair[two] - begin[of1[two]])
        whole &= place < end2[of2[two]]
        out[two[whole]] = self.prob2[place[whole]]
        return out


def save(arrays: dict[str, np.ndarray], uri: str) -> None:
    """Write the arrays to one file of any store: a JSON header, then each at a multiple of 64."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_output_stream(path) as f:
        f.write(len(text).to_bytes(8, "little") + text + bytes(-(8 + len(text)) % 64))
        for a in arrays.values():
            f.write(a.tobytes() + bytes(-a.nbytes % 64))


def load(uri: str) -> dict[str, np.ndarray]:
    """The arrays as views: of the mapped file where the store is a mounted file system,
    elsewhere of its bytes."""
    fs, path = pafs.FileSystem.from_uri(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        with open(path, "rb") as f:
            held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with fs.open_input_file(path) as f:
            held = f.read()
    n = int.from_bytes(held[:8], "little")
    body = 8 + n + (-(8 + n) % 64)
    return {name: np.frombuffer(held, np.dtype(kind), count, body + at)
            for name, (kind, count, at) in json.loads(held[8:8 + n]).items()}


def remove(uri: str) -> None:
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.delete_file(path)
