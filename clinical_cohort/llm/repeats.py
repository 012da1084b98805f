"""Substring dedup by level-wise doubling of repeated word windows.

A window of ``WINDOW`` words is removed if its words also start earlier: in a
document of smaller key, or before it in the same document. Windows that repeat
at a quarter of the length are candidates at half of it, those that repeat
there are candidates at the full length; what repeats at no level is dropped.

First level: of the short windows inside each full window only the one of least
hash is taken (the leftmost of equals). Equal full windows take equal ones, so
no repeat is missed, and about one short window in eight is shuffled. Each level
counts hashes, keeps the places whose hash occurs twice, and sends them back to
their documents; the documents are shuffled once, as compressed words. The last
level compares 96 bits of hash and takes for each window the least key that has
it; the levels before only narrow the search.

Counts and least keys are pre-aggregated over batches of documents, so a passage that
any number of documents share has one row per batch where hashes meet. A copy of
a window inside one document needs no shuffle and is found on the spot.

Null and blank texts have no words; texts of fewer words than a window stay
whole, and very long ones are judged whole. Rows that share a key are judged alike against other keys and apart from
each other. Rows without key come before all others, in the order of a hash of
the text. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, utf8

WINDOW = 20
#: Words that are hashed at a time.
CHUNK_WORDS = 300_000
#: Documents whose hashes are pre-aggregated together.
BATCH_ROWS = 4_000
_MASK = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair(h: np.ndarray, shift: int, keep: int) -> np.ndarray:
    """Hash of two windows, the second ``shift`` words after the first."""
    return _mix(h[:keep] * np.uint64(0x9E3779B97F4A7C15) + h[shift:shift + keep])


class Chunk:
    """Window hashes over the words of several documents, one after another."""

    def __init__(self, docs: list[list[bytes]], window: int):
        self.window, self.base = window, -(-window // 4)
        self.sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        self.ends = np.cumsum(self.sizes)
        self.first = self.ends - self.sizes
        raw = b"".join([xxhash.xxh3_128_digest(w) for ws in docs for w in ws])
        lanes = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)
        n = max(0, len(lanes) - window + 1)
        self.short, self.double, self.full = [], [], []
        for lane in (lanes[:, 0], lanes[:, 1]):
            b = self.base
            short = np.zeros(max(0, len(lanes) - b + 1), np.uint64)
            for k in range(b):
                short = short * np.uint64(0xD6E8FEB86659FD93) + lane[k:k + len(short)]
            short = _mix(short)
            double = _pair(short, b, max(0, len(lanes) - 2 * b + 1))
            self.short.append(short)
            self.double.append(double)
            self.full.append(_pair(double, window - 2 * b, n))
        doc = np.repeat(np.arange(len(docs)), self.sizes)[:n]
        #: Starts of the windows that lie in one document, and their documents.
        self.starts = np.flatnonzero(np.arange(n) + window <= self.ends[doc]) if n else np.empty(0, np.int64)
        self.doc = doc[self.starts]

    def anchors(self) -> np.ndarray:
        """For every full window, the start of its short window of least hash."""
        if not len(self.starts):
            return self.starts
        inside = np.lib.stride_tricks.sliding_window_view(self.short[0], self.window - self.base + 1)
        return self.starts + inside[self.starts].argmin(axis=1)

    def halves(self) -> np.ndarray:
        """For every full window, the start of a window of twice the short length that holds its anchor."""
        a = self.anchors()
        return np.where(a + 2 * self.base <= self.starts + self.window, a, a - self.base)

    def marked(self, places: list[list[int]]) -> np.ndarray:
        """Flags of the words at the given places of each document."""
        out = np.zeros(int(self.ends[-1]) if len(self.ends) else 0, bool)
        for first, p in zip(self.first.tolist(), places, strict=True):
            out[first + np.array(p, np.int64)] = True
        return out

    def in_doc(self, h: np.ndarray) -> np.ndarray:
        """Hash of a window's hash and its document."""
        return _mix(h ^ (self.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))

    def removed(self, later: list[list[int]]) -> np.ndarray:
        """Flags of words in a window that a smaller key has, or that starts before in its document."""
        out = np.zeros(int(self.ends[-1]) + 1 if len(self.ends) else 1, np.int64)
        if len(self.starts):
            a, b = (self.full[i][self.starts] for i in (0, 1))
            again = np.ones(len(self.starts), bool)
            again[np.unique(self.in_doc(a ^ _mix(b)), return_index=True)[1]] = False
            sizes = np.fromiter(map(len, later), np.int64, len(later))
            known = np.array([h for x in later for h in x], np.uint64)
            owner = np.repeat(np.arange(len(later)), sizes).astype(np.uint64)
            known = _mix(known ^ (owner * np.uint64(0x9E3779B97F4A7C15)))
            gone = self.starts[again | np.isin(self.in_doc(a & _MASK), known)]
            np.add.at(out, gone, 1)
            np.add.at(out, gone + self.window, -1)
        return np.cumsum(out)[:-1] > 0


def _chunks(docs: list[list[bytes]], window: int):
    """(from, to, Chunk) over runs of documents of about CHUNK_WORDS words."""
    start = size = 0
    for i, ws in enumerate(docs):
        size += len(ws)
        if size >= CHUNK_WORDS or i + 1 == len(docs):
            yield start, i + 1, Chunk(docs[start:i + 1], window)
            start, size = i + 1, 0


def _mapped(df: DataFrame, schema: str, fn) -> DataFrame:
    """``fn(batch)`` yields tuples of columns for an output of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, BATCH_ROWS)):
            for columns in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return df.mapInArrow(run, schema)


def _unpacked(batch) -> list[list[bytes]]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(z).split() for z in batch.column("z").to_pylist()]


def _packed(rows: DataFrame) -> DataFrame:
    """Keys and each text's words, joined by one space and compressed."""
    def run(batch):
        pack = zstandard.ZstdCompressor(level=3).compress
        keys = batch.column("key").to_pylist()
        yield keys, batch.column("k").to_pylist(), [pack(b" ".join((t or b"").split())) for t in utf8(batch.column("t"))]
    return _mapped(rows, "key long, k long not null, z binary", run)


def _signed(h: np.ndarray) -> np.ndarray:
    return (h & _MASK).astype(np.int64)


def _spread(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Partition keys for rows that need not meet any other."""
    return _mix(h ^ _mix(k.astype(np.uint64))).view(np.int64)


def _counted(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Rows (g, k, place, n) of a batch's short windows (hash, k, place), pre-aggregated.

    A hash that the batch has once is asked for at g = hash with n = 1. One that
    it has more often repeats for certain: its places go to a partition of their
    own with n = 0, and one row (place -1) tells the other batches its count.
    """
    h, k, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    values, back, counts = np.unique(h, return_inverse=True, return_counts=True)
    sure = counts[back] > 1
    often = counts > 1
    told = values[often]
    yield (np.concatenate([np.where(sure, _spread(h, k), _signed(h)), _signed(told)]),
           np.concatenate([k, np.zeros(len(told), np.int64)]),
           np.concatenate([place, np.full(len(told), -1)]),
           np.concatenate([np.where(sure, 0, 1), counts[often]]))


def _repeated(windows: DataFrame) -> DataFrame:
    """(k, places) of the windows whose hash occurs at least twice.

    A hash has one row per batch at most, so the window function's groups are
    small however often a passage occurs.
    """
    total = F.sum("n").over(Window.partitionBy("g"))
    return (windows.withColumn("total", total).where("n = 0 or (n = 1 and total > 1)")
            .groupBy("k").agg(F.collect_list("place").alias("places")))


def _found(docs: DataFrame, window: int, text: str, key: str) -> DataFrame:
    """(key, z, later): packed words and the hashes of full windows that a smaller key has."""
    k = F.coalesce(F.col(key).cast("long"), F.xxhash64(text).bitwiseOR(F.lit(-2**63)))
    rows = docs.select(F.col(key).cast("long").alias("key"), k.alias("k"), F.col(text).alias("t"))
    packed = _packed(rows)
    counted = "g long, k long, place int, n int"

    def short(batch):
        keys, parts = batch.column("k").to_numpy(), []
        for a, b, c in _chunks([(t or b"").split() for t in utf8(batch.column("t"))], window):
            at, where = np.unique(c.anchors(), return_index=True)
            doc = c.doc[where]
            parts.append((c.short[0][at], keys[a:b][doc], at - c.first[doc]))
        yield from _counted(parts)

    def half(batch):
        keys, places, parts = batch.column("k").to_numpy(), batch.column("places").to_pylist(), []
        for a, b, c in _chunks(_unpacked(batch), window):
            alive = c.marked(places[a:b])[c.anchors()]
            at, where = np.unique(c.halves()[alive], return_index=True)
            doc = c.doc[alive][where]
            parts.append((c.double[0][at], keys[a:b][doc], at - c.first[doc]))
        yield from _counted(parts)

    def full(batch):
        """Rows (g, h, h2, k): the least key of each hash in the batch asks at g = h; larger ones are
        later for certain, have a null h2 and a partition of their own."""
        keys, places, parts = batch.column("k").to_numpy(), batch.column("places").to_pylist(), []
        for a, b, c in _chunks(_unpacked(batch), window):
            alive = c.marked(places[a:b])[c.halves()]
            x, y = (c.full[i][c.starts] for i in (0, 1))
            once = np.unique(c.in_doc(x ^ _mix(y))[alive], return_index=True)[1]
            parts.append((x[alive][once], y[alive][once], keys[a:b][c.doc[alive][once]]))
        x, y, k = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((k, y, x))
        x, y, k = x[order], y[order], k[order]
        same = np.zeros(len(x), bool)
        same[1:] = (x[1:] == x[:-1]) & (y[1:] == y[:-1])
        group_least = k[np.maximum.accumulate(np.where(same, 0, np.arange(len(x))))] if len(x) else k
        later, asks = k > group_least, ~same
        x48, y48 = _signed(x), _signed(y)
        keep = later | asks
        yield (np.where(later, _spread(x, k), x48)[keep], x48[keep],
               pa.array(y48[keep], mask=later[keep]), k[keep])

    # All three joins read the same columns of the packed texts, so Spark shuffles these once.
    level = _mapped(rows.select("k", "t"), counted, short)
    level = _mapped(packed.join(_repeated(level), "k").select("key", "k", "z", "places"), counted, half)
    level = _mapped(packed.join(_repeated(level), "k").select("key", "k", "z", "places"), "g long, h long, h2 long, k long", full)
    least = F.min("k").over(Window.partitionBy("g", "h2"))
    later = (level.withColumn("least", least).where("h2 is null or least < k")
             .groupBy("k").agg(F.collect_list("h").alias("later")))
    return packed.join(later, "k", "left").select(
        "key", "z", F.coalesce("later", F.array().cast("array<long>")).alias("later"))


def _judged(batch, window: int):
    """(words, flags of removed words) of each row."""
    later = batch.column("later").to_pylist()
    docs = _unpacked(batch)
    for a, b, c in _chunks(docs, window):
        gone = c.removed(later[a:b])
        for ws, first, end in zip(docs[a:b], c.first.tolist(), c.ends.tolist(), strict=True):
            yield ws, gone[first:end]


def _kept(ws: list[bytes], gone: np.ndarray) -> bytes:
    return b" ".join(ws if not gone.any() else [ws[i] for i in np.flatnonzero(~gone).tolist()])


def remove(docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_words, n_removed and ``kept``, the words that stay, joined by one space."""
    def run(batch):
        rows = list(_judged(batch, window))
        yield (batch.column("key").to_pylist(), [len(w) for w, _ in rows], [int(g.sum()) for _, g in rows],
               [_kept(w, g).decode() for w, g in rows])
    out = _mapped(_found(docs, window, text, key), "key long, n_words long, n_removed long, kept string", run)
    return out.withColumnRenamed("key", key)


def digest(docs: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """As `remove`, with the SHA-256 of the kept words in their place."""
    def run(batch):
        rows = list(_judged(batch, window))
        yield (batch.column("key").to_pylist(), [len(w) for w, _ in rows], [int(g.sum()) for _, g in rows],
               [hashlib.sha256(_kept(w, g)).hexdigest() for w, g in rows])
    out = _mapped(_found(docs, window, text, key), "key long, n_words long, n_removed long, kept_sha256 string", run)
    return out.withColumnRenamed("key", key)
