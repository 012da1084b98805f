"""SimHash near-duplicates by a grid range-join on segment popcounts.

A 64-bit fingerprint is cut into 32 segments of two bits; its embedding is the
vector of the segments' bit counts. Manhattan distance between embeddings never
exceeds Hamming distance, so pairs within ``max_distance`` lie within it there.
The vector is kept as thermometer codes (0: 00, 1: 01, 2: 11), so Manhattan
distance is the bit count of an exclusive or.

Grid join: of two embeddings within 4, one half of the segments (16) is within
2, so some grid point lies within 1 of both halves. Each distinct fingerprint
is sent to the cell of each of its halves and to that cell's neighbours at
distance 1 (25 cells a half on average). The fingerprints of a cell are tested
against each other by the lower bound and then by exact Hamming distance.

Groups need no more links than connect them, so a cell gives a spanning forest of
its links, not its pairs: n near copies cost n - 1 rows in each cell they share.
A cell of more than ``BLOCK`` fingerprints is cut into blocks, and every two of
its blocks are tested as a group of their own, so no group is larger than two blocks.

Texts are compared by fingerprint: rows of one fingerprint meet once, before
any join, so copies of any number cost one row. Links become groups by
connected components in distributed rounds.

Null and wordless texts have fingerprint zero and are linked like any other. Very
long texts are read whole, their shingles' bits added in parts.
Repeated rows share a group. Rows without id take part; a group's id is its
smallest id that is not null. Other columns are not read by `group` and are kept
by `deduplicate`. Empty tables give empty results.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, saved, utf8
from .graph import components

SHINGLE = 4
MAX_DISTANCE = 4
#: Fixed value: seed of XXH64.
SEED = 42

#: Fingerprints of a cell that are tested together, with one other block at most.
BLOCK = 4_096

_LOW = 0x5555555555555555
_HIGH = -0x5555555555555556  # the other bits, as a signed long
_HALF = 0xFFFFFFFF


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one text, as a signed 64-bit integer."""
    w = (text or b"").lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(shingle)), strict=False)) if len(w) >= shingle else [b" ".join(w)]
    digests = b"".join(map(xxhash.xxh64_digest, grams, repeat(SEED)))  # big-endian
    n = len(digests) // 8
    counts = np.zeros(64, np.int64)
    # Bytes of 0 and 1 are added eight at a time as words; 255 rows cannot overflow a byte.
    for at in range(0, len(digests), 8 * 65280):
        part = np.frombuffer(digests, np.uint8, min(8 * 65280, len(digests) - at), at)
        bits = np.unpackbits(part).view(np.uint64).reshape(-1, 8)
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``text_hash`` and ``fp``."""
    rows = docs.select(F.col(key), F.xxhash64(text).alias("text_hash"), F.col(text).alias("t"))
    return map_rows(rows, lambda b: [[fingerprint(t, shingle) for t in utf8(b.column("t"))]], "fp long",
                    keep=[key, "text_hash"])


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 segments, as thermometer codes."""
    any_bit = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(F.lit(_LOW))
    both = fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(F.lit(_HIGH))
    return any_bit.bitwiseOR(both)


def _cells(fps: DataFrame) -> DataFrame:
    """Each fingerprint with every grid cell that it is sent to.

    A row becomes fifty, so the few bytes of fingerprints are dealt to all partitions first.
    """
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    halves = fps.repartition(n, F.xxhash64("fp")).select("fp", embedding(F.col("fp")).alias("e")).select(
        "fp", F.posexplode(F.array(F.col("e").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("e", 32))))
    # Neighbours: a low code bit may change if the high one is 0, a high one if the low one is 1.
    near = F.expr("""concat(array(col), transform(filter(sequence(0, 31), b -> if(b % 2 = 0,
        shiftright(col, b + 1) & 1L = 0, shiftright(col, b - 1) & 1L = 1)), b -> col ^ shiftleft(1L, b)))""")
    return halves.select("fp", F.explode(near).alias("cell"), "pos").select(
        "fp", F.shiftleft("cell", 1).bitwiseOR(F.col("pos")).alias("cell"))


def _forest(fps: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what links of at most ``max_distance`` bits connect, one fewer than the fingerprints of each part."""
    codes = (fps >> np.uint64(1) | fps) & np.uint64(_LOW) | (fps << np.uint64(1) & fps) & np.uint64(_LOW << 1)
    left, frontier = np.arange(len(fps)), []
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    while len(left):
        if not frontier:
            frontier.append(left[0])
            left = left[1:]
        at = frontier.pop()
        near = np.flatnonzero(np.bitwise_count(codes[left] ^ codes[at]) <= max_distance)  # the lower bound
        near = near[np.bitwise_count(fps[left[near]] ^ fps[at]) <= max_distance]
        if len(near):
            a.append(np.repeat(fps[at], len(near)))
            b.append(fps[left[near]])
            frontier += left[near].tolist()
            left = np.delete(left, near)
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _linked(keys: np.ndarray, members: np.ndarray, ends: np.ndarray, max_distance: int):
    """Links (a, b), a < b, of the groups of rows that end at ``ends``."""
    out = []
    starts = np.concatenate([[0], ends[:-1]])
    several = ends - starts > 1
    for at, end in zip(starts[several].tolist(), ends[several].tolist(), strict=True):
        if end - at == 2:
            x, y = members[at:end].tolist()
            if (x ^ y).bit_count() <= max_distance:
                out.append((members[at:at + 1], members[at + 1:end]))
        else:
            out.append(_forest(members[at:end], max_distance))
    sides = zip(*out, strict=True) if out else ((), ())
    x, y = (np.concatenate([np.empty(0, np.uint64), *side]).view(np.int64) for side in sides)
    return np.minimum(x, y), np.maximum(x, y)


def _forests(groups: DataFrame, by: list[str], max_distance: int, block: int | None = None) -> DataFrame:
    """(a, b, cell): the links of each group of rows (by, fp) with equal ``by``.

    Groups of more than ``block`` rows are given back as they are, as rows (fp, null, cell).
    """
    import pyarrow as pa
    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = block or 1 << 62

    def rows(a, b, cell):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(cell, pa.int64())], names=["a", "b", "cell"])

    def back(keys, members):
        return rows(members.view(np.int64), [None] * len(members), keys[:, 0])

    def run(batches):
        keys, members, open_large = np.empty((0, len(by)), np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            keys = np.concatenate([keys, np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in by])])
            members = np.concatenate([members, batch.column("fp").to_numpy().view(np.uint64)])
            if open_large is not None:  # the rest of a group that is given back
                first = np.append(np.flatnonzero(np.any(keys != open_large, axis=1)), len(keys))[0]
                yield back(keys[:first], members[:first])
                keys, members = keys[first:], members[first:]
                if not len(keys):
                    continue
                open_large = None
            ends = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            last = ends[-1] if len(ends) else 0  # the last group may go on in the next batch
            if len(ends):
                yield from finished(keys[:last], members[:last], ends)
                keys, members = keys[last:], members[last:]
            if len(keys) > most:
                open_large = keys[0]
                yield back(keys, members)
                keys, members = keys[:0], members[:0]
        if len(keys):
            yield from finished(keys, members, np.array([len(keys)]))

    def finished(keys, members, ends):
        sizes = np.diff(ends, prepend=0)
        large = np.repeat(sizes > most, sizes)
        if large.any():
            yield back(keys[large], members[large])
            keys, members, ends = keys[~large], members[~large], np.cumsum(sizes[sizes <= most])
        if len(keys):
            a, b = _linked(keys, members, ends, max_distance)
            yield rows(a, b, [None] * len(a))

    dealt = groups.repartition(n, *by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "a long, b long, cell long")


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """(cell, i, j, fp): the members of every two blocks of each cell; members has (cell, fp)."""
    sizes = members.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    return members.join(sizes.hint("merge"), "cell").select(
        "cell", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``max_distance`` bits apart, enough of them to connect
    all that such pairs connect; fps has distinct ``fp``."""
    if not 0 <= max_distance <= 4:
        raise ValueError("halves are joined at Manhattan distance 2, which finds pairs of up to 4 bits")
    first = saved(_forests(_cells(fps), ["cell"], max_distance, block), "links")
    large = first.where("cell is not null").select("cell", F.col("a").alias("fp"))
    rest = _forests(_blocks(large, block), ["cell", "i", "j"], max_distance)
    return first.where("cell is null").unionByName(rest).select("a", "b").distinct()


def _grouped(docs: DataFrame, shingle: int, max_distance: int, text: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(key, text_hash, fp) of every row, and (fp, root) of every distinct fingerprint."""
    prints = saved(fingerprints(docs, shingle, text, key), "fingerprints")
    fps = prints.select("fp").distinct()
    found = components(links(fps, max_distance))
    roots = fps.join(found, fps["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints, roots


def group(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, text: str = "text",
          key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``fp`` (long) and ``component_id``, the smallest key reachable over links."""
    prints, roots = _grouped(docs, shingle, max_distance, text, key)
    least = prints.groupBy("fp").agg(F.min(key).alias("k")).join(roots, "fp")
    ids = least.groupBy("root").agg(F.min("k").alias("component_id"))
    return prints.join(least.join(ids, "root").select("fp", "component_id"), "fp").select(key, "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_distance: int = MAX_DISTANCE, text: str = "text",
                key: str = "doc_id") -> DataFrame:
    """One document of each group, the one of the smallest key, with all its columns.

    Of rows that have that key and the same text one stays, the first by its other columns as JSON.
    """
    prints, roots = _grouped(docs, shingle, max_distance, text, key)
    first = F.min(F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("k"), F.col("text_hash").alias("h")))
    kept = (prints.groupBy("fp").agg(first.alias("first")).join(roots, "fp")
            .groupBy("root").agg(F.min("first").alias("first")).select("first.k", "first.h"))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("rk"), F.xxhash64(text).alias("rh"))
    chosen = rows.join(kept, rows["rk"].eqNullSafe(kept["k"]) & (rows["rh"] == kept["h"]), "left_semi")
    others = [F.col(f"row.`{c}`") for c in docs.columns if c != text]
    return chosen.groupBy("rk", "rh").agg(F.min_by("row", F.to_json(F.struct(*others))).alias("row")).select("row.*")
