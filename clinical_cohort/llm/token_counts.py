"""Token counts by a map-side two-tier lookup of pre-token lengths.

The tokenizer drops white space and encodes the pre-tokens between its splits one
by one, so a text has as many tokens as its pre-tokens together. The first tier
is a compact table, broadcast once: the most frequent pre-tokens, as one run of
bytes, and their lengths in tokens. The second is a cache in each worker for the
pre-tokens that are not in it, which the library encodes when they are first met.
No pre-token is shuffled: the table is drawn from a sample of rows (``SAMPLE_ROWS``
in all, ``SAMPLE_TOKENS`` pre-tokens for each), and sample and cache decide about
time alone, as a length is the library's wherever it is found.

Pre-tokens of ASCII text are the runs of letters, single digits, runs of other
characters and contractions that the tokenizer's own pattern makes of it. A piece
between white space that holds other characters, or the start of a special token's
string, is looked up whole, so that normal forms, case and special strings stay
the library's work.

Null and empty texts have no bytes and no tokens. Very long texts are read whole;
the cache is emptied when it is full. Rows of one key or text are counted each. Other columns
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, utf8

#: Rows, on average, that the frequent pre-tokens are drawn from, and pre-tokens taken for each of them.
SAMPLE_ROWS, SAMPLE_TOKENS = 2_000, 200
#: Most pre-tokens of the broadcast table, and of a worker's cache.
FREQUENT, CACHED = 65_536, 1_000_000
#: The limit that `over_limit` compares with.
LIMIT = 2048

#: Fixed value: the tokenizer's split pattern, for lower-cased ASCII text.
_ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0D0-9a-z]+")
_SPECIAL = b"<|"


def pre_tokens(text: bytes) -> list[bytes]:
    """What a text is looked up by, in order."""
    if text.isascii() and _SPECIAL not in text:
        return _ASCII.findall(text.lower())
    out: list[bytes] = []
    for piece in text.split():
        if piece.isascii() and _SPECIAL not in piece:
            out += _ASCII.findall(piece.lower())
        else:
            out.append(piece)
    return out


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _lengths(path: str, tokens: list[bytes]) -> list[int]:
    made = _tokenizer(path).encode_batch([t.decode() for t in tokens], add_special_tokens=False)
    return [len(e.ids) for e in made]


def frequent(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, size: int = FREQUENT, text: str = "text") -> list[bytes]:
    """The ``size`` most frequent pre-tokens of a random sample of rows.

    Each task of the sample sends at most ``SAMPLE_TOKENS`` counts a row, which
    bounds what the driver adds up.
    """
    n = docs.count()
    if not n or not size:
        return []

    def count(batches):
        seen, rows = Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for raw in utf8(batch.column("t")):
                seen.update(pre_tokens(raw or b""))
        top = seen.most_common(rows * SAMPLE_TOKENS)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.binary()), pa.array([k for _, k in top], pa.int64())],
                                         names=["token", "n"])

    sample = docs.select(F.col(text).alias("t")).where(F.rand(13) < sample_rows / n)
    total: Counter[bytes] = Counter()
    for row in sample.mapInArrow(count, "token binary, n long").toLocalIterator():
        total[bytes(row["token"])] += row["n"]
    return [t for t, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:size]]


def pack(tokens: list[bytes], lengths: list[int]) -> bytes:
    """The table as one Arrow image: the tokens' bytes, their offsets and their lengths in tokens."""
    batch = pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array(lengths, pa.uint32())], names=["token", "n"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


class Lookup:
    """Both tiers in a worker: the shared table, and lengths found since."""

    def __init__(self, image: bytes, path: str, cached: int = CACHED):
        self.path, self.cached = path, cached
        batch = pa.ipc.open_stream(image).read_all()
        self.table = dict(zip(batch["token"].to_pylist(), batch["n"].to_pylist(), strict=True))
        self.cache: dict[bytes, int] = {}

    def count(self, texts: list[bytes]) -> list[int]:
        """Tokens of each text; what neither tier holds is encoded together."""
        if len(self.cache) > self.cached:
            self.cache.clear()
        totals, misses, table = [], [], self.table
        for i, text in enumerate(texts):
            tokens = pre_tokens(text)
            found = list(map(table.get, tokens))
            if None in found:
                misses.append((i, Counter(t for t, n in zip(tokens, found, strict=True) if n is None)))
                found = [n for n in found if n is not None]
            totals.append(sum(found))
        new = list({t: None for _, own in misses for t in own if t not in self.cache})
        self.cache.update(zip(new, _lengths(self.path, new), strict=True))
        for i, own in misses:
            totals[i] += sum(self.cache[t] * k for t, k in own.items())
        return totals


@lru_cache(maxsize=1)
def _lookup(shared, path: str, cached: int) -> Lookup:
    """One per worker process and table."""
    return Lookup(shared.value, path, cached)


def count(docs: DataFrame, tokenizer: str, limit: int = LIMIT, sample_rows: int = SAMPLE_ROWS, size: int = FREQUENT,
          cached: int = CACHED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    tokens = frequent(docs, sample_rows, size, text)
    shared = docs.sparkSession.sparkContext.broadcast(pack(tokens, _lengths(tokenizer, tokens)))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))

    def counted(batch):
        texts = [t or b"" for t in utf8(batch.column("t"))]
        return [list(map(len, texts)), _lookup(shared, tokenizer, cached).count(texts)]

    out = map_rows(rows, counted, "n_bytes long, n_tokens long", keep=["k"])
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
