"""Spelling variants: words one edit apart, by asymmetric q-chunks.

Of two words at most one edit apart, the shorter (of equal lengths the smaller)
gives two disjoint chunks, its first and last half; the other gives its positional
grams of that size. One edit leaves one of the chunks whole, and moves the last
one by as many places as the lengths differ, so chunk and gram meet at a shift of
one at most. The other half then holds the edit, and one of its own halves is
whole: it is part of the key, so no key is shorter than about three quarters of a
word and the groups of a common prefix or ending stay small. Pairs that meet are
verified by edit distance.

Words are counted with partial counts per task before the one shuffle of the
texts' words. Each word's form is its most frequent near word, if that is frequent
enough; forms are followed to the root by pointer doubling.

Null and empty texts have no words. Very long texts and words are read whole. Repeated
rows count each. Rows without a key keep their words as they are (`runs_of`).
Of equally frequent near words the smallest in code-point order is the form. Other columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, saved, slices, utf8

#: Fewest code points and occurrences of a word, and how much more frequent its form has to be.
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: One in this many pairs of a document and a run loses a letter before it is counted.
DAMAGED = 199
#: Distinct words that a task adds up before it sends their counts.
HELD = 200_000

#: Fixed value: what a run consists of, once A-Z are lower-cased.
_LETTERS = "a-zÀ-ÿ"


def runs_of(text: bytes, key: object, min_length: int = MIN_LENGTH, damaged: int = DAMAGED) -> Counter:
    """Words of a text of ``min_length`` code points or more, a letter deleted where the key's and run's crc32 says so."""
    found = Counter(re.findall(f"[{_LETTERS}]{{{min_length},}}", text.lower().decode()))  # bytes: only A-Z are lowered
    if key is None or not damaged:
        return found
    prefix = zlib.crc32(f"{key}:".encode())
    hit = [(found[r], r, h) for r in found if not (h := zlib.crc32(r.encode(), prefix)) % damaged]
    found.subtract({r: n for n, r, _ in hit})
    for n, r, h in hit:
        at = h % len(r)
        if len(r) > min_length:
            found[r[:at] + r[at + 1:]] += n
    return +found  # without zeros


def count(docs: DataFrame, min_length: int = MIN_LENGTH, damaged: int = DAMAGED, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n) over all texts."""

    def run(batches):
        total: Counter[str] = Counter()
        for batch in (part for whole in batches for part in slices(whole)):
            for k, raw in zip(batch.column("k").to_pylist(), utf8(batch.column("t")), strict=True):
                if raw:
                    total.update(runs_of(raw, k, min_length, damaged))
            if len(total) >= HELD:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
                total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _keys(word: Column, size: Column, shorter: Column, side: str) -> list[Column]:
    """The two keys of ``word`` for its first or last ``size`` code points, as words of ``shorter`` code points have them.

    The rest of the shorter word is cut in two; the key takes its first part, where it touches the
    chunk, or its last.
    """
    n, rest = F.char_length(word), shorter - size
    near = (rest / 2).cast("int")
    far = rest - near
    if side == "first":  # chunk, rest: near part after the chunk, far part at the end
        parts = (F.substring(word, F.lit(1), size + near),
                 F.concat_ws(" ", F.substring(word, F.lit(1), size), F.substring(word, n - far + 1, far)))
    else:
        parts = (F.substring(word, n - size - near + 1, size + near),
                 F.concat_ws(" ", F.substring(word, F.lit(1), far), F.substring(word, n - size + 1, size)))
    return [F.concat_ws(":", shorter.cast("string"), F.lit(side + kind), p)
            for kind, p in zip(("near", "far"), parts, strict=True)]


def meeting(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(a, n_a, b, n_b): words of which a chunk of the shorter meets a gram of the other, once for each such key."""
    word, length = F.col("word"), F.char_length("word")
    chunks = words.select("word", "n", F.explode(F.array(*[
        k for side in ("first", "last") for k in _keys(word, (length / 2).cast("int"), length, side)])).alias("key"))
    # Grams for partners of the same length and of one code point less, of no length below the least.
    grams = words.select("word", "n", F.explode(F.concat(*[
        F.when(length - less >= min_length, F.array(*[
            k for side in ("first", "last") for k in _keys(word, ((length - less) / 2).cast("int"), length - less, side)]))
        .otherwise(F.array().cast("array<string>")) for less in (0, 1)])).alias("key"))
    a = chunks.select("key", word.alias("a"), F.col("n").alias("n_a"))
    b = grams.select("key", word.alias("b"), F.col("n").alias("n_b"))
    larger = (F.char_length("b") > F.char_length("a")) | (F.col("a") < F.col("b"))
    return a.join(b.hint("merge"), "key").where(larger).drop("key")


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(a, n_a, b, n_b): pairs of words one inserted, deleted or replaced code point apart, each once; words has (word, n)."""
    return (meeting(words, min_length).where(F.levenshtein("a", "b", 1) == 1)
            .groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b")))


def forms(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) for every row of words (word, n)."""
    pairs = near_pairs(words, min_length)
    both = pairs.select(F.inline(F.array(*[
        F.struct(F.col(w).alias("word"), F.struct((-F.col(f"n_{o}")).alias("m"), F.col(o).alias("near")).alias("other"))
        for w, o in (("a", "b"), ("b", "a"))])))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("other").alias("best"))
    enough = -F.col("best.m") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word that following forms leads to.

    A form has more occurrences than its word, so there are no rings; each round doubles the steps taken.
    """
    steps = saved(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = saved(steps.select("word", "root").join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        discard(steps)
        steps, done = moved, not moved.where("moved").limit(1).count()
        if done:
            return steps.select("word", "root")


def group(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, damaged: int = DAMAGED,
          text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per word: word, ``n``, ``n_near``, ``form``, ``form_n`` and ``root``."""
    if min_length < 4 or ratio < 2:
        raise ValueError("words of four letters or more are cut into chunks, and a form has to be more frequent")
    words = saved(count(docs, min_length, damaged, text, key).where(F.col("n") >= min_count), "words")
    formed = saved(forms(words, min_length, ratio), "forms")
    discard(words)
    return formed.join(roots(formed), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
