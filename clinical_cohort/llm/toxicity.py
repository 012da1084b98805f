"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Words (lower-cased runs of letters) are framed by start and end marks and cut
into n-grams of ``ORDER`` characters. Each class, toxic and ordinary, has its own
counts of the longest n-grams; all shorter ones are continuation counts over both
classes (in how many longer n-grams a shorter one ends), so a rare expression is
smoothed alike for both and only what a class has seen tells them apart.

The score compares the two log-likelihoods, of the text divided by its number of
n-grams, and of the one word that speaks most for the toxic class (a few words
can make a long text toxic). A logistic function of the two differences gives a
value of 0 to 1. It is fitted on a bounded sample of labelled rows of every
training fold, each scored by the class counts of the other folds; rows weigh by the
share of their class that the sample holds.

Counts cover every labelled training row, as grouped sums with partial sums per
batch, one column for each class and fold, so one table tells the differences by all
folds (``without`` 0) and by all but one. The most frequent contexts of the table are
broadcast with all that follows them (at most ``SHARED`` hashes and numbers, 16 bytes
each); a text's words that have another context are joined with the table, each
distinct word once. Both ways give the same, at every size.

Null, empty and letterless texts have differences of 0. Very long texts and words are
read whole. Labels that are null or whose rows are not in the table count nothing;
several labels of one key count each. Repeated documents get equal scores. If either
class has no row, every score is the share of toxic rows (0.5 without any). Empty
tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, map_rows, saved, slices

ORDER = 5
DISCOUNT = 0.75
FOLDS = 5
#: Most labelled rows that the logistic function is fitted on, half of them of each class.
FIT_ROWS = 4_000
#: Most n-grams and contexts whose differences are broadcast.
SHARED = 4_000_000
START, END = "\x02", "\x03"


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5: 0 is held out, the others are counted."""
    return F.crc32(key.cast("string").cast("binary")) % FOLDS


def _words(texts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of an Arrow string array, and for each word of the texts its place and its row."""
    low = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\P{L}+", " ")
    cut = pc.split_pattern(low, " ")
    coded = cut.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), pc.list_parent_indices(cut).to_numpy()


class _Grams:
    """The n-grams of distinct words, as rows of code points; ``word`` is each one's word."""

    def __init__(self, words: list[str], order: int):
        text = "".join([START * (order - 1) + w + END if w else "" for w in words])
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) + order if w else 0 for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes)
        last = np.arange(len(codes)) - (ends - sizes)[word] >= order - 1
        self.codes = np.lib.stride_tricks.sliding_window_view(codes, order)[np.flatnonzero(last) - order + 1] \
            if len(codes) else np.empty((0, order), np.uint32)
        self.word = word[last]

    def hashes(self, length: int) -> np.ndarray:
        """64-bit hash of the first ``length`` characters of each n-gram."""
        h = np.zeros(len(self.codes), np.uint64)
        for k in range(length):
            h = (h ^ self.codes[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (h >> np.uint64(29))
        return h

    def texts(self, rows: np.ndarray) -> list[str]:
        order = self.codes.shape[1]
        flat = self.codes[rows].astype("<u4").tobytes().decode("utf-32-le")
        return [flat[i:i + order] for i in range(0, len(flat), order)]


CLASSES = ("toxic", "ordinary")
TRAINING = range(1, FOLDS)
_SUMS = [f"{c}{f}" for f in TRAINING for c in CLASSES]


def count(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, toxic1, ordinary1, toxic2, ...): counts by class and fold over rows with columns ``t``, ``toxic`` and ``fold`` (1 to 4)."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            words, place, row = _words(batch.column("t"))
            group = (2 * batch.column("fold").to_numpy() - 1 - batch.column("toxic").to_numpy())[row]
            grams = _Grams(words, order)
            _, at, back = np.unique(grams.hashes(order), return_index=True, return_inverse=True)
            own = [np.bincount(place[group == g], minlength=len(words))[grams.word] for g in range(len(_SUMS))]
            n = [np.bincount(back, weights=x, minlength=len(at)).astype(np.int64) for x in own]
            yield pa.RecordBatch.from_arrays([pa.array(grams.texts(at)), *map(pa.array, n)], names=["gram", *_SUMS])

    schema = "gram string, " + ", ".join(f"{c} long" for c in _SUMS)
    return rows.mapInArrow(run, schema).groupBy("gram").agg(*[F.sum(c).alias(c) for c in _SUMS])


def _without(label: str, fold: int) -> Column:
    """A class's count by all folds but one (0: by all)."""
    return sum((F.col(f"{label}{f}") for f in TRAINING if f != fold), F.lit(0))


def _shared(grams: DataFrame, order: int) -> DataFrame:
    """(s, p): Kneser-Ney probability of the last character of ``s`` after the others, from continuation counts."""
    counts = {order: grams.select(F.col("gram").alias("s"))}
    for k in range(order - 1, 0, -1):
        counts[k] = counts[k + 1].groupBy(F.substring("s", 2, k).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    p = counts[1].select("s", (F.col("n") / counts[1].agg(F.sum("n")).scalar()).alias("p"))
    for k in range(2, order):
        h = F.substring("s", 1, k - 1)
        context = counts[k].groupBy(h.alias("h")).agg(F.sum("n").alias("sum"), F.count(F.lit(1)).alias("types"))
        lower = p.select(F.col("s").alias("low"), F.col("p").alias("p_low"))
        p = (counts[k].withColumn("h", h).withColumn("low", F.substring("s", 2, k - 1))
             .join(context, "h").join(lower, "low")
             .select("s", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("types") * F.col("p_low")) / F.col("sum")).alias("p")))
    return p


def model(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """(h, n, deltas, back): for each context of ``order - 1`` characters how often it occurs, and the log-likelihood
    differences of the characters that follow it, by character, and of all others; each an array by the fold left out (0: none)."""
    h = F.substring("gram", 1, order - 1)
    context = counted.groupBy(h.alias("h")).agg(*[x for c in CLASSES for f in range(FOLDS) for x in (
        F.sum(_without(c, f)).alias(f"{c}{f}_sum"), F.sum((_without(c, f) > 0).cast("int")).alias(f"{c}{f}_types"))])
    shared = _shared(counted, order).select(F.col("s").alias("low"), "p")

    def back(c: str, f: int) -> Column:
        n = F.col(f"{c}{f}_sum")
        return F.when(n > 0, DISCOUNT * F.col(f"{c}{f}_types") / n).otherwise(1.0)

    def likelihood(c: str, f: int) -> Column:
        own = F.when(_without(c, f) > 0, (_without(c, f) - DISCOUNT) / F.col(f"{c}{f}_sum")).otherwise(0.0)
        return F.log(own + back(c, f) * F.col("p"))

    deltas = F.array(*[likelihood("toxic", f) - likelihood("ordinary", f) for f in range(FOLDS)])
    grams = (counted.withColumn("h", h).withColumn("low", F.substring("gram", 2, order - 1))
             .join(context, "h").join(shared, "low"))
    # A context is followed by no more characters than there are.
    followed = grams.groupBy("h").agg(F.map_from_entries(F.collect_list(
        F.struct(F.substring("gram", order, 1).alias("last"), deltas.alias("delta")))).alias("deltas"))
    n = F.col("toxic0_sum") + F.col("ordinary0_sum")
    return followed.join(context, "h").select("h", n.alias("n"), "deltas", F.array(*[
        F.log(back("toxic", f)) - F.log(back("ordinary", f)) for f in range(FOLDS)]).alias("back"))


def word_differences(words: DataFrame, table: DataFrame, folds: int = 1, order: int = ORDER) -> DataFrame:
    """``words`` (a column ``word``, distinct) with ``totals``, the summed differences of a word's n-grams by the first
    ``folds`` of the folds left out, and ``grams``, their number."""

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole)):
            cut = _Grams(batch.column("word").to_pylist(), order)
            texts = pa.array(cut.texts(np.arange(len(cut.word))), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(cut.word)), pc.utf8_slice_codeunits(texts, 0, order - 1),
                                              pc.utf8_slice_codeunits(texts, order - 1, order)], names=["word", "h", "last"])

    spread = words.select("word").mapInArrow(run, "word string, h string, last string")
    joined = spread.join(table.hint("merge"), "h", "left")
    delta = F.coalesce(F.try_element_at("deltas", F.col("last")), F.col("back"))
    each = joined.select("word", *[F.coalesce(delta[f], F.lit(0.0)).alias(f"d{f}") for f in range(folds)])
    summed = each.groupBy("word").agg(F.array(*[F.sum(f"d{f}") for f in range(folds)]).alias("totals"), F.count(F.lit(1)).cast("int").alias("grams"))
    return words.join(summed, "word")


class _Shared:
    """Differences of n-grams and contexts by hash; without ``complete``, other contexts may be in the table."""

    def __init__(self, order: int, hashes: np.ndarray, delta: np.ndarray, context: np.ndarray, complete: bool):
        self.order, self.complete, self.parts = order, complete, []
        for which in (~context, context):
            at = np.argsort(hashes[which])
            self.parts.append((hashes[which][at], delta[which][at]))

    def _find(self, part: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, delta = self.parts[part]
        if not len(hashes):
            return np.zeros(len(h), bool), np.zeros(len(h))
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        known = hashes[at] == h
        return known, np.where(known, delta[at], 0.0)

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word whether its difference is known here, the difference, and its number of n-grams."""
        grams = _Grams(words, self.order)
        seen, delta = self._find(0, grams.hashes(self.order))
        known, back = self._find(1, grams.hashes(self.order - 1))
        n = np.bincount(grams.word, minlength=len(words))
        total = np.bincount(grams.word, weights=np.where(seen, delta, back), minlength=len(words))
        sure = np.ones(len(words), bool) if self.complete else np.bincount(grams.word, weights=~known, minlength=len(words)) == 0
        return sure, np.where(sure, total, 0.0), np.where(sure, n, 0)


@lru_cache(maxsize=1)
def _table(shared) -> _Shared:
    return _Shared(*shared.value)


def _frequent(table: DataFrame, most: int, order: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, bool]:
    """What `_Shared` takes, of the contexts above the least power of two of occurrences that ``most`` entries reach."""
    power = F.floor(F.log2("n")).cast("int")
    entries = F.sum(F.size("deltas") + 1)
    sizes = {r["p"]: r["k"] for r in table.groupBy(power.alias("p")).agg(entries.alias("k")).collect()}  # a row for each power
    least, held = 64, 0
    for p in sorted(sizes, reverse=True):
        held += sizes[p]
        if held > most:
            break
        least = p
    complete = held <= most

    def run(batches):
        for batch in batches:
            h = batch.column("h").to_pylist()
            last, delta, owner = batch.column("last"), batch.column("delta"), pc.list_parent_indices(batch.column("last")).to_pylist()
            follow = [h[i] + c for i, c in zip(owner, last.flatten().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([_hash(follow, order), _hash(h, order - 1)]).view(np.int64)),
                pa.array(np.concatenate([delta.flatten().to_numpy(), batch.column("back").to_numpy()])),
                pa.array(np.repeat([False, True], [len(follow), len(h)]))], names=["hash", "delta", "context"])

    values = F.transform(F.map_values("deltas"), lambda d: d[0])
    got = (table.where(power >= least).select("h", F.map_keys("deltas").alias("last"), values.alias("delta"), F.col("back")[0].alias("back"))
           .mapInArrow(run, "hash long, delta double, context boolean").toPandas())
    return order, got["hash"].to_numpy(np.int64).view(np.uint64), got["delta"].to_numpy(float), got["context"].to_numpy(bool), complete


def _hash(texts: list[str], length: int) -> np.ndarray:
    """As `_Grams.hashes`, of texts of ``length`` characters."""
    out = _Grams([], length)
    out.codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(-1, length)
    return out.hashes(length)


def differences(rows: DataFrame, table: DataFrame, shared: tuple | None = None, folds: int = 1, order: int = ORDER) -> DataFrame:
    """``rows`` (with columns ``t`` and ``without``, the fold left out or 0) with ``mean``, the difference per n-gram,
    and ``top``, the largest difference of a word, in place of the text.

    Words that ``shared`` (of `_frequent`, for ``without`` 0) knows need no join with the table.
    """
    none = np.empty(0)
    known = rows.sparkSession.sparkContext.broadcast(shared or (order, none.astype(np.uint64), none, none.astype(bool), False))
    keep = [c for c in rows.columns if c != "t"]

    def run(batch):
        names, place, row = _words(batch.column("t"))
        sure, total, n = _table(known).look_up(names)
        sums = np.bincount(row, weights=total[place], minlength=batch.num_rows)
        counts = np.bincount(row, weights=n[place], minlength=batch.num_rows)
        top = np.full(batch.num_rows, -np.inf)
        found = n[place] > 0
        np.maximum.at(top, row[found], total[place[found]])
        rest: list[dict[int, int]] = [{} for _ in range(batch.num_rows)]
        real = np.fromiter(map(bool, names), bool, len(names))
        left = np.flatnonzero((real & ~sure)[place])
        for r, w in zip(row[left].tolist(), place[left].tolist(), strict=True):
            rest[r][w] = rest[r].get(w, 0) + 1
        return [sums, counts, top, [[{"word": names[w], "times": k} for w, k in own.items()] for own in rest]]

    part = saved(map_rows(rows.withColumn("rid", F.monotonically_increasing_id()), run,
                          "sums double, counts double, most double, rest array<struct<word:string,times:long>>", keep=[*keep, "rid"]), "parts")
    loose = part.select("rid", "without", F.inline("rest"))
    words = word_differences(loose.select("word").distinct(), table, folds, order)
    each = loose.join(words.hint("merge"), "word").withColumn("total", F.get("totals", F.col("without")))
    added = each.groupBy("rid").agg(F.sum(F.col("times") * F.col("total")).alias("more_sums"),
                                    F.sum(F.col("times") * F.col("grams")).alias("more_counts"), F.max("total").alias("more_most"))
    whole = part.join(added.hint("merge"), "rid", "left")
    sums = F.col("sums") + F.coalesce("more_sums", F.lit(0.0))
    counts = F.col("counts") + F.coalesce("more_counts", F.lit(0))
    top = F.greatest("most", "more_most")
    return whole.select(*keep, F.coalesce(F.try_divide(sums, counts), F.lit(0.0)).alias("mean"),
                        F.when(counts > 0, top).otherwise(0.0).alias("top"))


FEATURES = ["mean", "top"]


def fit(sample: pd.DataFrame, prior: float) -> list[float]:
    """Slopes of the features and offset of the logistic function, by Newton's method with a small ridge; rows weigh ``weight``."""
    x, y = sample[FEATURES].to_numpy(float), sample["toxic"].to_numpy(float)
    if not len(x) or y.min() == y.max():
        return [0.0, 0.0, float(np.log(prior / (1 - prior))) if 0 < prior < 1 else 0.0]
    weight = sample["weight"].to_numpy(float)
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    design = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(design.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(len(w)),
                               design.T @ (weight * (y - p)) - 1e-2 * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return [*(w[:-1] / scale).tolist(), float(w[-1])]


def score(docs: DataFrame, labels: DataFrame, order: int = ORDER, shared: int = SHARED, fit_rows: int = FIT_ROWS,
          text: str = "text", key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """One row per document: key, held_out, score and predicted, learned from labels outside the held-out fold.

    The logistic function is fitted on the labelled rows of each class with the smallest hashes of the key.
    """
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    marks = labels.where(F.col(label).isNotNull() & (fold(F.col(key)) != 0)).select(
        F.col(key).alias("k"), (F.col(label) != 0).cast("int").alias("toxic"))
    own_fold = fold(F.col("k")).cast("int")
    # Merge joins at every size: labels grow with the documents and are never broadcast.
    train = rows.join(marks.hint("merge"), "k").select("t", "toxic", own_fold.alias("fold"))
    counted = saved(count(train, order), "grams")
    table = saved(model(counted, order), "differences")
    discard(counted)

    marked = rows.select("k").join(marks.hint("merge"), "k")
    sizes = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = fit_rows // 2
    chosen = [marked.where(F.col("toxic") == c).distinct().orderBy(F.xxhash64("k"), "k").limit(half) for c in (0, 1)]
    picked = saved(chosen[0].unionByName(chosen[1]), "sample")  # at most fit_rows keys
    sample = saved(rows.join(F.broadcast(picked), "k").select("k", "t", "toxic", own_fold.alias("without")), "sample")
    known = differences(sample, table, folds=FOLDS, order=order)
    got = known.orderBy(F.xxhash64("k"), "k", *FEATURES).limit(fit_rows).toPandas()
    discard(picked, sample)
    seen = got.groupby("toxic").size().to_dict()
    got["weight"] = [sizes[c] / seen[c] for c in got["toxic"]]
    *slopes, offset = fit(got, sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5)

    p = 1 / (1 + F.exp(-sum((F.lit(w) * F.col(f) for w, f in zip(slopes, FEATURES, strict=True)), F.lit(offset))))
    scored = differences(rows.withColumn("without", F.lit(0)), table, _frequent(table, shared, order), order=order)
    return scored.select(
        F.col("k").alias(key), F.coalesce(fold(F.col("k")) == 0, F.lit(False)).alias("held_out"), p.alias("score"),
        (p >= 0.5).cast("int").alias("predicted"))
