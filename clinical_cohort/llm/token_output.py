"""Token-id output: documents as ids in patched frame-of-reference files.

Documents are dealt to shards by ranges of the key and sorted inside, so shard
after shard holds ascending keys (null keys first; rows of one key by a hash of
the text, so that one key's rows can be spread over shards too). Each shard is
encoded where it lies and written as segments: rows of a Parquet table, each
with the image of whole documents' ids, their keys and lengths, and the place of
its first id in the shard. Readers add the totals of the shards before.

Texts are encoded as the library does by default: the string of an added token is
that token. Null and empty texts are the end id alone. Very long texts are encoded whole.
Repeated rows are encoded each. Keys are whole numbers. Other
columns are not read. An empty table gives empty files and an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import pfor

END_ID = 0
SEGMENT_IDS = 65_536
CACHED_CHUNKS = 1_000_000

#: A space with a visible character on either side: no token of a byte-level BPE
#: with this split pattern spans the place before it, so texts can be cut there.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: RE2: white space at an end of the text or beside another, or the mark that is put at cuts.
_UNSAFE = r"^[ \n]|[ \n]$|[\s\x0b\x1c-\x1f\x{85}\p{Z}][ \n]|[ \n][\s\x0b\x1c-\x1f\x{85}\p{Z}]|\x00"
#: Cuts in other texts: before each space, around each line break, and between a word and the full stops,
#: commas or the like that end it; the split pattern ends a token at all of them.
_MARK = "\0"
_STOP = r"([\p{L}\p{N}])([.,;:!?]+)(\x00|$)"

SCHEMA = "shard int, segment int, first long, n_ids long, keys array<long>, lengths array<int>, image binary"


class Encoder:
    """Ids of whole texts, by chunks between single spaces that are encoded once each."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        special = "|".join(map(re.escape, self.specials)) or r"(?!)"
        # A space, then no other: visible characters at both ends, and no added token.
        self.joins = re.compile(rf" (?!.*(?:{special}))\S(?:[^ ]*\S)?", re.DOTALL).fullmatch
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, bool)  # ids whose token starts with a space
        for token, i in vocab.items():
            self.opens[i] = token.startswith("Ġ")
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.uint32)
        self.used = 0

    def _add(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(self.place), len(chunks)
        if n + k > len(self.starts):
            self.starts, self.lengths = (np.concatenate([a, np.zeros(n + k, np.int64)]) for a in (self.starts, self.lengths))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(self.used + len(ids), np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[n:n + k] = self.used + np.cumsum(lengths) - lengths
        self.lengths[n:n + k] = lengths
        self.used += len(ids)
        self.place.update(zip(chunks, range(n, n + k), strict=True))

    def learn(self, chunks: list[str]) -> np.ndarray:
        """Cache the chunks; their places. Chunks that start with their only space are encoded together."""
        places = list(map(self.place.get, chunks))
        new = dict.fromkeys([c for c, at in zip(chunks, places, strict=True) if at is None])
        joined = list(filter(self.joins, new))
        for at in range(0, len(joined), 5000):
            part = joined[at:at + 5000]
            # The fast batch call keeps no offsets; its ids are those of encode.
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            opens = np.flatnonzero(self.opens[ids])
            self._add(part, ids, np.diff(opens, append=len(ids)))
        single = [c for c in new if c not in self.place]
        if single:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(single, add_special_tokens=False)]
            self._add(single, np.array([i for x in ids for i in x], np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))
        if new:
            places = [self.place[c] if at is None else at for c, at in zip(chunks, places, strict=True)]
        return np.array(places, np.int64)

    def _gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[places]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[places] - ends + lengths, lengths)
        return self.pool[shift + np.arange(len(shift))], lengths

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an Arrow string array, one text after another, and the number of ids of each text."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(self.place) > CACHED_CHUNKS:
            self._clear()
        texts = pc.fill_null(texts, "")
        unsafe = pc.match_substring_regex(texts, _UNSAFE)
        for special in self.specials:
            unsafe = pc.or_(unsafe, pc.match_substring(texts, special))
        unsafe = unsafe.to_numpy(zero_copy_only=False)
        marked = pc.replace_substring(pc.if_else(pa.array(unsafe), "", texts), " ", _MARK + " ")
        marked = pc.replace_substring(marked, "\n", _MARK + "\n" + _MARK)
        marked = pc.replace_substring_regex(marked, _STOP, "\\1" + _MARK + "\\2\\3")
        cut = pc.split_pattern(marked, _MARK)
        pieces = cut.flatten().dictionary_encode()
        first = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        # By way of NumPy: to_pylist makes an Arrow scalar of each string.
        places = self.learn(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        bounds = np.append(first, len(places))
        odd = np.flatnonzero(unsafe).tolist()
        if odd:
            parts, at, counts = [], 0, np.diff(bounds)
            for i in odd:
                chunks = _CUT.split(texts[i].as_py())
                parts += [places[bounds[at]:bounds[i]], self.learn(chunks[:1] + [" " + c for c in chunks[1:]])]
                counts[i] = len(chunks)
                at = i + 1
            places = np.concatenate([*parts, places[bounds[at]:]])
            bounds = np.concatenate([[0], np.cumsum(counts)])
        ids, lengths = self._gather(places)
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(total[bounds])


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One per worker process: later tasks find the chunks that earlier ones have encoded."""
    return Encoder(path)


def _with_ends(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(lengths)
    return np.insert(ids, ends, END_ID), lengths + 1


def write(docs: DataFrame, path: str, tokenizer: str, shards: int | None = None, text: str = "text", key: str = "doc_id") -> None:
    """Encode every document, in ascending key order, into the segment table at ``path``."""
    import pyarrow as pa
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = docs.sparkSession
    schema = to_arrow_schema(StructType.fromDDL(SCHEMA))
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("i"),
                       F.col(text).alias("t"))
    dealt = rows.repartitionByRange(shards, "k", "h", "i").sortWithinPartitions("k", "h", "i").select("k", "t")

    def run(batches):
        encoder = _encoder(tokenizer)
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            keys = batch.column("k").to_pylist()
            ids, lengths = _with_ends(*encoder.encode(batch.column("t")))
            ends = np.cumsum(lengths)
            a = 0
            while a < len(keys):
                done = ends[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(ends, done + SEGMENT_IDS, "right")))  # whole documents, one at least
                part = ids[done:ends[b - 1]]
                row = [shard, segment, first, len(part), keys[a:b], lengths[a:b].tolist(), pfor.encode(part)]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)
                a, segment, first = b, segment + 1, first + len(part)

    dealt.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: key, start (ids of all documents before), n_tokens, ids_crc32."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema = to_arrow_schema(StructType.fromDDL(out))
    segments = spark.read.schema(SCHEMA).parquet(path)
    # One row per shard: the window orders, and the join broadcasts, as many rows as the writer had partitions.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = segments.join(F.broadcast(bases), "shard").select((F.col("base") + F.col("first")).alias("first"), "keys", "lengths", "image")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = pfor.decode(row["image"]).astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
                columns = [row["keys"], row["first"] + ends - lengths, lengths, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return placed.mapInArrow(run, out)
