"""Periodic runs of words by an online sparse diagonal DP.

A run is a stretch of words with smallest period q that is at least
``max(MIN_WORDS, 2 * q)`` words long and that no neighbouring word extends. Words
q apart are equal along it, so it is a diagonal of matches at lag q: the words of
a text are read once, in order; each one's earlier occurrences add to the match
lengths of the lags that are active, and a diagonal that ends long enough emits
its run at once.

The DP is kept sparse without losing a run. A run's diagonal has at least
``SEED = MIN_WORDS // 2`` matches, so a lag becomes active only when that many
words match, which is looked up by the word with the ``SEED - 1`` before it, among
earlier places whose word before those differs (elsewhere the lag is active
already). A lag is not opened where hashes tell that the words do not match as far
as a run of it has to reach, nor where a smaller active lag divides it and has
matched as far back as the new one reaches: such a stretch repeats a shorter one
and ends with it. A text without repeated ``SEED``-grams costs one sort.

Null, empty and blank texts have no words and no run. Very long texts are read
whole; a text of one word repeated has one active lag. Repeated rows are judged
each. Rows without a key are not rewritten (`planted`). Other columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, utf8

#: Fewest words of a run.
MIN_WORDS = 12
_STEP = np.uint64(0x9E3779B97F4A7C15)


def planted(words: list[bytes], key: object) -> list[bytes]:
    """The words of a document; of one in ten, by the key's crc32, the words from some place on repeat with some period."""
    n = len(words)
    if key is None or not n:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[:n - a]


class Hashes:
    """64-bit hashes of stretches of words, from sums over all words before a place."""

    def __init__(self, codes: np.ndarray):
        word = (codes + np.uint64(1)) * _STEP
        word = (word ^ (word >> np.uint64(29))) * _STEP
        self.powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(len(codes), _STEP)))
        # The word at place k weighs powers[k]: a shift by d multiplies a stretch's sum by powers[d].
        self.sums = np.append(np.uint64(0), np.cumsum(word * self.powers[:-1]))

    def grams(self, size: int) -> np.ndarray:
        """The hash of the ``size`` words that end at each place from ``size - 1`` on, alike wherever they stand."""
        own = self.sums[size:] - self.sums[:-size]
        return own * self.powers[:len(own)][::-1]

    def equal(self, start: int, ends: np.ndarray, lags: np.ndarray) -> np.ndarray:
        """Whether the words from ``start`` to each of ``ends`` have the hash of those a lag before them."""
        here = self.sums[ends] - self.sums[start]
        before = self.sums[ends - lags] - self.sums[start - lags]
        return here == before * self.powers[lags]


class Diagonals:
    """The active lags of one text, and the runs emitted so far."""

    def __init__(self, words: list[int], grams: list[int], hashes: Hashes, seed: int, min_words: int):
        self.words, self.grams, self.hashes, self.seed, self.min_words = words, grams, hashes, seed, min_words
        self.active: dict[int, int] = {}  # lag: its match length at the last word read
        self.runs: dict[tuple[int, int], int] = {}  # (start, end): smallest period
        self.places: dict[int, dict[int, array]] = {}  # gram: word before it: places, in order

    def _emit(self, lag: int, matched: int, end: int) -> None:
        if matched >= lag and matched + lag >= self.min_words:
            at = (end - matched - lag, end)
            self.runs[at] = min(lag, self.runs.get(at, lag))

    def _reaching(self, i: int, earlier: array) -> list[int]:
        """Lags from word ``i`` to earlier places whose hashes match as far as a run of that lag needs."""
        first = i + 1 - self.seed
        lags = i - np.array(earlier)
        ends = first + np.maximum(lags, self.min_words - lags)
        lags, ends = lags[ends <= len(self.words)], ends[ends <= len(self.words)]
        return lags[self.hashes.equal(first, ends, lags)].tolist()

    def _opens(self, i: int, lag: int) -> bool:
        """Whether the diagonal of ``lag`` whose first ``seed`` matches end at word ``i`` is to be followed."""
        w, first = self.words, i + 1 - self.seed
        if any(lag % q == 0 and matched + q >= lag + self.seed for q, matched in self.active.items()):
            return False
        return w[first:i + 1] == w[first - lag:i + 1 - lag]

    def read(self, i: int) -> None:
        """Word ``i``: adds to the active lags, ends those it does not match, and opens new ones."""
        w, active = self.words, self.active
        if active:
            for lag in [q for q in active if w[i] != w[i - q]]:
                self._emit(lag, active.pop(lag), i)
            for lag in active:
                active[lag] += 1
        if i + 1 < self.seed:
            return
        before = w[i - self.seed] if i >= self.seed else -1
        places = self.places.setdefault(self.grams[i], {})
        new = [lag for other, earlier in places.items() if other != before for lag in self._reaching(i, earlier)]
        for lag in sorted(new):  # a smaller one may divide a larger one
            if self._opens(i, lag):
                active[lag] = self.seed
        places.setdefault(before, array("q")).append(i)

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start and period."""
        for lag, matched in self.active.items():
            self._emit(lag, matched, len(self.words))
        return sorted(((a, b - a, q) for (a, b), q in self.runs.items()), key=lambda r: (r[0], r[2]))


def runs(words: list[bytes], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    seed = min_words // 2
    if len(words) < min_words:
        return []
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for w in words]
    hashes = Hashes(np.array(codes, np.uint64))
    grams = hashes.grams(seed)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    order += seed - 1
    if not same.any():
        return []
    repeated = np.zeros(len(words) + 1, bool)
    repeated[order[1:][same]] = repeated[order[:-1][same]] = True
    repeated[1:] |= repeated[:-1]  # the word after a diagonal's last ends it
    found = Diagonals(codes, [0] * (seed - 1) + grams.tolist(), hashes, seed, min_words)
    for i in np.flatnonzero(repeated[:-1]).tolist():
        found.read(i)
    return found.finish()


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run has after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def detect(docs: DataFrame, min_words: int = MIN_WORDS, plant: bool = False, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``runs`` (array of start, length, period) and ``collapsed``, the words that stay.

    ``plant`` rewrites one document in ten first (see `planted`).
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))

    def run(batch):
        out, left = [], []
        for k, raw in zip(batch.column("k").to_pylist(), utf8(batch.column("t")), strict=True):
            words = (raw or b"").split()  # bytes: only ASCII white space splits
            if plant:
                words = planted(words, k)
            found = runs(words, min_words)
            out.append([{"start": a, "length": n, "period": q} for a, n, q in found])
            left.append(b" ".join(collapsed(words, found)).decode())
        return [out, left]

    made = map_rows(rows, run, "runs array<struct<start:long,length:long,period:long>>, collapsed string", keep=["k"])
    return made.select(F.col("k").alias(key), "runs", "collapsed")


def digest(docs: DataFrame, min_words: int = MIN_WORDS, plant: bool = True, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``n_runs``, the longest run, and hashes of all runs and of the words that stay."""
    found = detect(docs, min_words, plant, text, key)
    # The longest; of those the first start, then the smallest period: the order that the runs have.
    longest = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
                          lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return (found.select(F.col(key), F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                         F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select(key, "n_runs", "best.start", "best.length", "best.period",
                    F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))
