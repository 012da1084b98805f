r"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all normalised items accepts every run of words of any item.
Each document's words are streamed through it; the state and the length of the
longest match that ends at a word tell which windows of items end there. A
window is ``WINDOW`` consecutive words of an item, or a whole shorter item.

The items are a given query set. It is read in blocks of about
``max_block_words`` words (by a hash of the item, so no block grows with the
data). The driver collects one block at a time and hands it to Spark as a file to
broadcast; one stage with one Python worker a task streams the documents. A worker
takes ``HELD_BYTES`` of texts, sends them through the automaton of each block in
turn, and holds one automaton at a time, which it keeps for its next task if there is one block.

Null and wordless texts have no words: not contaminated. Very long texts are
streamed whole. Items without words
match nothing; items without id mark words but are not listed. Repeated
documents get equal rows; repeated items count once per id. Without items nothing is
hit; an empty table of documents gives an empty result. Other columns are
not read by `match` and are kept by `clean`.
"""

from __future__ import annotations

import re
import string
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, release, utf8

WINDOW = 10
#: Words of a block of items, and bytes of texts that pass through all blocks together.
BLOCK_WORDS, HELD_BYTES = 200_000, 32 << 20
#: Fixed value: what is no word character, in lower-cased UTF-8.
NON_WORD = bytes(c for c in range(0x80) if chr(c) not in string.ascii_letters + string.digits)
_TABLE = bytes(0x20 if c in NON_WORD else c for c in range(256)).lower()
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, ws in items:
            last = 0
            for w in ws:
                last = self._extend(last, w)
        n = len(self.next)
        #: Per state: its own or the nearest linked state that holds windows of full length.
        self.holder = [-1] * n
        self.windows: dict[int, set[str | None]] = {}
        self.short: dict[int, dict[int, set[str | None]]] = {}
        order = sorted(range(n), key=self.length.__getitem__)
        for s in order[1:]:
            if self.length[s] >= window:
                self.holder[s] = s if self.length[self.link[s]] < window else self.holder[self.link[s]]
        for item, ws in items:
            s = 0
            for i, w in enumerate(ws):
                s = self.next[s][w]
                if i + 1 >= window:
                    self.windows.setdefault(self.holder[s], set()).add(item)
                    s = self._of_length(s, min(i + 1, window))
            if 0 < len(ws) < window:
                self.short.setdefault(s, {}).setdefault(len(ws), set()).add(item)
        #: Per state: the nearest state, itself included, at which a short item ends.
        self.short_at = [-1] * n
        for s in order[1:]:
            self.short_at[s] = s if s in self.short else self.short_at[self.link[s]]
        self.least = min([len(ws) for _, ws in items if ws], default=0) if self.short else window

    def _of_length(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a match of ``n`` or more that ended in ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _new(self, edges: dict[bytes, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: bytes) -> int:
        """The state for the match of p followed by w, cloned from q if q also stands for longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:  # an earlier item has this run
            return self._split(last, self.next[last][w], w)
        new = self._new({}, 0, self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][w], w)
        return new

    def stream(self, ws: list[bytes]) -> tuple[list[list[int]], set[str | None]]:
        """Merged intervals of words inside occurring windows, and the windows' items."""
        intervals: list[list[int]] = []
        found: set[str | None] = set()
        root, nexts, link, length = self.next[0], self.next, self.link, self.length

        def mark(start: int, end: int) -> None:
            while intervals and intervals[-1][1] >= start:
                start = min(start, intervals.pop()[0])
            intervals.append([start, end])

        # A word of no item sends the automaton to its root, so only runs of known words need be streamed.
        known = np.fromiter(map(root.__contains__, ws), bool, len(ws))
        edges = np.flatnonzero(np.diff(known, prepend=False, append=False))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a < self.least:
                continue
            state = matched = 0
            for i in range(a, b):
                w = ws[i]
                while w not in nexts[state]:
                    state = link[state]
                    matched = length[state]
                state = nexts[state][w]
                matched += 1
                if matched >= self.window:
                    found |= self.windows[self.holder[state]]
                    mark(i + 1 - self.window, i + 1)
                s = self.short_at[state]
                while s > 0:
                    for n, items in self.short[s].items():
                        if n <= matched:
                            found |= items
                            mark(i + 1 - n, i + 1)
                    s = self.short_at[link[s]]
        return intervals, found


def _blocks(items: DataFrame, max_block_words: int, text: str, key: str):
    """The items' (id, text), block by block."""
    rows = items.select(F.col(key).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (4 * max_block_words)))  # a word and its separator have four characters or more, nearly always
    for i in range(n):
        yield rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).collect()


@lru_cache(maxsize=1)
def _automaton(shared, window: int) -> SuffixAutomaton:
    """The automaton of a block, one per worker process; the block's texts are not kept."""
    items = shared.value
    del shared._value  # read from the broadcast's file again if the block is needed again
    return SuffixAutomaton([(k, words(t.encode())) for k, t in items], window)


def _streamed(docs: DataFrame, items: DataFrame, window: int, max_block_words: int, text: str, item_text: str, item_key: str) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (word intervals) and ``hit_items`` appended; docs has columns row, text."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    added = StructType.fromDDL("n_words long, hits array<array<int>>, hit_items array<string>")
    types = to_arrow_schema(added)
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast([(r["item"], r["text"]) for r in block]) for block in _blocks(items, max_block_words, item_text, item_key)]

    def judged(batches):
        texts = [raw or b"" for batch in batches for raw in utf8(batch.column("text"))]
        n = [0] * len(texts)
        hits: list[list[list[int]]] = [[] for _ in texts]
        found: list[set[str | None]] = [set() for _ in texts]
        for block in blocks:
            automaton = _automaton(block, window)
            for i, raw in enumerate(texts):
                ws = words(raw)
                n[i] = len(ws)
                h, f = automaton.stream(ws)
                if h:
                    hits[i] = merged(hits[i] + h)
                    found[i] |= f
        named = [sorted(x for x in f if x is not None) for f in found]
        at = 0
        for batch in batches:
            end = at + batch.num_rows
            new = [pa.array(c[at:end], f.type) for c, f in zip((n, hits, named), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), *new], names=["row", "text", *types.names])
            at = end

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= HELD_BYTES:
                yield from judged(held)
                held, size = [], 0
        yield from judged(held)
        release()

    return docs.select("row", "text").mapInArrow(run, StructType([docs.schema["row"], docs.schema["text"], *added.fields]))


def merged(intervals: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def match(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_block_words: int = BLOCK_WORDS, text: str = "text",
          key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row per document: key, ``n_words``, ``n_hit``, ``hits`` (word intervals) and ``hit_items``."""
    rows = docs.select(F.struct(F.col(key)).alias("row"), F.col(text).alias("text"))
    out = _streamed(rows, items, window, max_block_words, text, item_text, item_key)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h[1] - h[0])
    return out.select(F.col("row")[key].alias(key), "n_words", n_hit.alias("n_hit"), "hits", "hit_items")


def without(text: bytes, hits: list[list[int]]) -> bytes:
    """The text without the characters from the first to the last word of each interval."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, end = [], 0
    for a, b in hits:
        out.append(text[end:places[a][0]])
        end = places[b - 1][1]
    return b"".join([*out, text[end:]])


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_span: int = 1, max_coverage: float = 0.5,
          max_block_words: int = BLOCK_WORDS, text: str = "text", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The documents without contaminated spans of ``min_span`` words or more; all columns stay.

    Documents of which more than ``max_coverage`` of the words are hit are dropped.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    out = _streamed(rows, items, window, max_block_words, text, item_text, item_key)

    def cut(batch):
        return [[None if raw is None else (without(raw, [h for h in hits if h[1] - h[0] >= min_span]) if hits else raw).decode()
                 for raw, hits in zip(utf8(batch.column("text")), batch.column("hits").to_pylist(), strict=True)]]

    n_hit: Column = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h[1] - h[0])
    kept = out.where(n_hit <= F.col("n_words") * F.lit(max_coverage))
    new = map_rows(kept, cut, "cleaned string", keep=["row"])
    return new.select(*[(F.col("cleaned") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
