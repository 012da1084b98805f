"""Phenotype feature tables.

The reference pivots every family to a wide frame (one extra job per pivot
to find its values), left-joins the pivots and collects the result to
pandas. Here the main representation is **long**: one row per
``(visit_occurrence_id, feature, value)`` with only non-zero counts. Every
family is one ``groupBy`` over its events; families are unioned, not
joined; a wide matrix is produced only at the end (``to_wide``, with an
explicit feature list) or as sparse vectors for Spark ML.

Feature names follow the reference: a family prefix (``CCTBL_``, ``DETBL_``,
``MEDTBL_``, ``UTTBL_``, ``BCTBL_``, ``ACHTBL_``, ``METBL_``), '.' replaced
by '_' where the reference does so, and the characters `` ,;{}()\\n\\t=``
removed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .filters import flag_is

KEY = "visit_occurrence_id"
# Code pattern and roll-up levels of the reference.
ICD_PATTERN = r"[A-TV-Z][0-9][0-9AB]\.?[0-9A-TV-Z]{0,4}"
ICD_LEVELS = (1, 2, 3, 5, 6, 7, 8)
STRIP_CHARS = " ,;{}()\n\t="


def quoted(name: str) -> str:
    """Column reference for a name that may hold dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def clean_feature(name: Column, prefix: str, dots: bool) -> Column:
    """Feature name: prefix + name ('.'->'_' if ``dots``) without `` ,;{}()\\n\\t=``; null -> 'null'."""
    n = F.coalesce(name.cast("string"), F.lit("null"))
    if dots:
        n = F.translate(n, ".", "_")
    # Deleting every listed character equals replacing runs of them by ''.
    return F.concat(F.lit(prefix), F.translate(n, STRIP_CHARS, ""))


def code_prefix(code: str | Column, level: int | Column, pattern: str = ICD_PATTERN) -> Column:
    """M8: upper-case prefix of ``level`` characters for codes matching the
    (unanchored, case-sensitive) pattern; other codes stay whole, upper-cased."""
    c = F.col(code) if isinstance(code, str) else code
    lv = F.lit(level) if isinstance(level, int) else level
    upper = F.upper(c)
    return F.when(c.rlike(pattern), F.substring(upper, F.lit(1), lv)).otherwise(upper)


def category_counts(df: DataFrame, category: str, prefix: str, key: str = KEY, dots: bool = False) -> DataFrame:
    """A9/A12/A13 long form: (key, feature, value=count) per key and category."""
    return (df.groupBy(key, clean_feature(F.col(category), prefix, dots).alias("feature"))
              .agg(F.count(F.lit(1)).alias("value")))


def pivot_counts(df: DataFrame, category: str, prefix: str, values: Sequence[str], key: str = KEY) -> DataFrame:
    """A9 wide form with an explicit value list (no discovery job), 0 when absent."""
    wide = df.groupBy(key).pivot(category, list(values)).agg(F.count(F.lit(1)))
    return wide.select(key, *[F.coalesce(F.col(quoted(str(v))), F.lit(0)).cast("bigint").alias(prefix + str(v))
                              for v in values])


def _dictionary(names: DataFrame, code_cols: Sequence[str], name: str = "feature") -> DataFrame:
    """(code columns, features): the features (their column ``name``) of each distinct code, each at its first level only.

    ``names`` lists (code columns, level, feature) of the distinct codes. A
    feature keeps the lowest level at which any code has it; the levels are
    broadcast, a row for each feature name.
    """
    first = names.groupBy("feature").agg(F.min("level").alias("_first"))
    kept = names.join(F.broadcast(first), "feature").where(F.col("level") == F.col("_first"))
    return kept.groupBy(*code_cols).agg(F.collect_list(name).alias("_features"))  # at most one per level


def spread(df: DataFrame, key: str = KEY) -> DataFrame:
    """``df`` dealt by ``key`` over twice the session's shuffle partitions.

    Rows that the next step multiplies are dealt while they are few; a partition
    is then whole for every grouping that has ``key`` in it, and small enough for
    its groups to fit a task. The families share the number, so their union keeps it.
    """
    return df.repartition(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _dealt(n: DataFrame, key: str, base: DataFrame | None) -> DataFrame:
    """One row per key and code, dealt by key and cut to the keys of ``base``."""
    return restrict_keys(n, base, key) if base is not None else spread(n, key)


def _summed(rows: DataFrame, key: str, name: str = "feature") -> DataFrame:
    """(key, feature, value) from dealt rows, one per key and code with its number ``_n`` and its ``_features``."""
    e = rows.select(key, "_n", F.explode("_features").alias(name))
    return e.groupBy(key, name).agg(F.sum("_n").alias("value"))


def _same(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> Column:
    """Rows of ``a`` whose ``cols`` are those of ``b``, there named ``_0``, ``_1``, ...; null equals null."""
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[f"_{i}"]) for i, c in enumerate(cols)])


def _numbered(dictionary: DataFrame, cols: Sequence[str]) -> DataFrame:
    return dictionary.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(cols)], "_features")


def _code_names(df: DataFrame, keep: Sequence[str], code: str, levels: Sequence[int], pattern: str,
                prefix: str) -> DataFrame:
    """(keep..., level, feature): the names a code yields at each level, repeats dropped."""
    # The pattern test and upper-casing run once per row, before the rows
    # are multiplied by the number of levels.
    # A code yields the same name at consecutive levels once it is shorter
    # than the level (or at every level when it does not match); only the
    # first of such repeats can be the name's lowest level, so the repeats
    # are dropped before counting - exact, and fewer rows to shuffle.
    levels = list(levels)
    pairs = F.array(*[F.struct(F.lit(lv).alias("level"), F.lit(prev).cast("int").alias("prev"))
                      for lv, prev in zip(levels, [None, *levels[:-1]])])
    e = df.select(*keep, F.upper(F.col(code)).alias("_up"), F.col(code).rlike(pattern).alias("_m"))
    e = e.select(*keep, "_up", "_m", F.inline(pairs))
    first_of_run = F.col("prev").isNull() | (F.col("_m") & (F.length("_up") > F.col("prev")))
    name = F.when(F.col("_m"), F.substring(F.col("_up"), F.lit(1), F.col("level"))).otherwise(F.col("_up"))
    return e.where(first_of_run).select(*keep, "level", clean_feature(name, prefix, True).alias("feature"))


def code_level_counts(df: DataFrame, code: str = "condition_source_value", key: str = KEY,
                      levels: Sequence[int] = ICD_LEVELS, pattern: str = ICD_PATTERN,
                      prefix: str = "DETBL_", base: DataFrame | None = None) -> DataFrame:
    """A10: hierarchical code roll-up counts per key in long form.

    Events are counted per code; a dictionary over the distinct codes gives
    each code's names (its prefixes at the given levels), and every name keeps
    the count of the lowest level at which it occurs. With ``base`` only its
    keys are returned; levels are those of all events. The dictionary is
    broadcast: it has the codes of one coding system, however many events.
    It meets the counted codes after they are dealt, so that names are not shuffled.
    """
    names = _code_names(df.select(code).distinct(), [code], code, levels, pattern, prefix)
    n = df.groupBy(key, code).agg(F.count(F.lit(1)).alias("_n"))
    d = _numbered(_dictionary(names, [code]), [code])
    n = _dealt(n, key, base)
    return _summed(n.join(F.broadcast(d), _same(n, d, [code])), key)


def _class_names(df: DataFrame, keep: Sequence[str], level_cols: Sequence[str], prefix: str) -> DataFrame:
    items = F.array(*[F.struct(F.lit(i + 1).alias("level"), F.col(c).cast("string").alias("name"))
                      for i, c in enumerate(level_cols)])
    e = df.select(*keep, F.inline(items))
    return e.select(*keep, "level", clean_feature(F.col("name"), prefix, True).alias("feature"))


def class_level_counts(df: DataFrame, level_cols: Sequence[str], key: str = KEY, prefix: str = "MEDTBL_",
                       classes: DataFrame | None = None, on: str | None = None, base: DataFrame | None = None) -> DataFrame:
    """Class-hierarchy counts (ATC 1-5 style); a lower level wins on equal names.

    As A10, over the distinct class tuples. The classes are columns of ``df``,
    or of ``classes``, a table of them by the code ``on``: events are then
    counted per code, and only a code's names meet them. Codes without an
    event have no say in the levels.
    """
    cols = list(level_cols)
    if classes is None:
        d = _numbered(_dictionary(_class_names(df.select(*cols).distinct(), cols, cols, prefix), cols), cols)
        n = df.groupBy(key, *cols).agg(F.count(F.lit(1)).alias("_n"))
        return _summed(_dealt(n.join(d, _same(n, d, cols)).select(key, "_n", "_features"), key, base), key)
    seen = classes.select(on, *cols).join(df.select(on).distinct(), on, "left_semi")
    names = _class_names(seen.select(*cols).distinct(), cols, cols, prefix)
    # Codes are many, so their features are shuffled beside them: as numbers, which get their names after the counting.
    numbers = names.select("feature").distinct().withColumn("_number", F.row_number().over(Window.orderBy("feature")))
    d = _numbered(_dictionary(names.join(F.broadcast(numbers), "feature"), cols, "_number"), cols)
    n = df.groupBy(key, on).agg(F.count(F.lit(1)).alias("_n"))
    named = n.join(seen.join(d, _same(seen, d, cols)).select(on, "_features"), on).select(key, "_n", "_features")
    return _summed(_dealt(named, key, base), key, "_number").join(F.broadcast(numbers), "_number").select(key, "feature", "value")


def flag_counts(df: DataFrame, flag: str, category: str, prefix: str, positive: bool = True,
                key: str = KEY) -> DataFrame:
    """Counts per category among rows whose text flag is True (or False)."""
    return category_counts(df.where(flag_is(flag, positive)), category, prefix, key)


def flag_total(df: DataFrame, flag: str, name: str, prefix: str = "ACHTBL_", key: str = KEY) -> DataFrame:
    """Number of positive rows per key as one feature."""
    return (df.where(flag_is(flag, True)).groupBy(key)
              .agg(F.count(F.lit(1)).alias("value"))
              .select(key, F.lit(prefix + name).alias("feature"), "value"))


def numeric_passthrough(df: DataFrame, prefix: str = "METBL_", key: str = KEY) -> DataFrame:
    """Numeric per-key columns as features (missing -> 0, prefixed names)."""
    cols = [c for c in df.columns if c != key]
    items = F.array(*[F.struct(F.lit(prefix + c).alias("feature"),
                               F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias("value")) for c in cols])
    return df.select(key, F.inline(items))


def binarize(long_df: DataFrame) -> DataFrame:
    """Value >= 1 -> 1, else 0 (as INT)."""
    return long_df.withColumn("value", (F.col("value") >= 1).cast("int"))


def drop_rare(long_df: DataFrame, min_support: int = 100, prefix: str | None = "DETBL_") -> DataFrame:
    """Drop features (of ``prefix`` only) whose column sum is below ``min_support``.

    Support is summed over the prefixed features only, and only those rows
    meet the set of rare names in an anti join; it is broadcast, as it has at
    most one row per feature name, all of which a matrix lists anyway. Rows of
    other families pass untouched. Splitting the rows this way keeps the
    anti join an equi join in every branch (a family whose feature name is
    a constant would otherwise turn it into a nested-loop join).
    """
    if not prefix:
        rare = (long_df.groupBy("feature").agg(F.sum("value").alias("_support"))
                       .where(F.col("_support") < min_support).select("feature"))
        return long_df.join(F.broadcast(rare), "feature", "left_anti")
    is_pref = F.coalesce(F.col("feature").startswith(prefix), F.lit(False))
    cand = long_df.where(is_pref)
    rare = (cand.groupBy("feature").agg(F.sum("value").alias("_support"))
                .where(F.col("_support") < min_support).select("feature"))
    return cand.join(F.broadcast(rare), "feature", "left_anti").unionByName(long_df.where(~is_pref))


def family_counts(long_df: DataFrame) -> DataFrame:
    """Number of distinct features per family prefix (text up to the first '_')."""
    fam = F.concat(F.substring_index("feature", "_", 1), F.lit("_"))
    return long_df.groupBy(fam.alias("family")).agg(F.count_distinct("feature").alias("n_features"))


def target_counts(targets: DataFrame, key: str = KEY) -> DataFrame:
    """Positives per target column -> (target, positives)."""
    cols = [c for c in targets.columns if c != key]
    row = targets.agg(*[F.sum(F.col(c)).cast("bigint").alias(c) for c in cols])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).alias("positives"))
                                         for c in cols])))


def restrict_keys(long_df: DataFrame, base: DataFrame, key: str = KEY) -> DataFrame:
    """Keep feature rows of the base visits (left-semi join, both sides dealt alike, see ``spread``)."""
    return spread(long_df, key).join(spread(base.select(key), key), key, "left_semi")


def feature_matrix(families: dict[str, DataFrame], base: DataFrame | None = None, key: str = KEY,
                   min_support: int = 100, rare_prefix: str | None = "DETBL_") -> DataFrame:
    """Families by prefix, restricted to base visits, binarised, rare features dropped, as one long table.

    Families that were made for the base visits already need no ``base``.
    Support concerns the family of ``rare_prefix`` alone, so only that one is
    read for it; the others are united untouched.
    """
    out = None
    for prefix, f in families.items():
        rows = f.select(key, "feature", F.col("value").cast("double").alias("value"))
        if base is not None:
            rows = restrict_keys(rows, base, key)
        rows = binarize(rows)
        if prefix == rare_prefix:
            rows = drop_rare(rows, min_support, None)
        out = rows if out is None else out.unionByName(rows)
    return out


def to_wide(long_df: DataFrame, features: Sequence[str], key: str = KEY) -> DataFrame:
    """Wide export of a long table with an explicit feature list, 0 when absent."""
    wide = long_df.groupBy(key).pivot("feature", list(features)).agg(F.sum("value"))
    return wide.select(key, *[F.coalesce(F.col(quoted(n)), F.lit(0)).alias(n) for n in features])


def feature_labels(long_df: DataFrame, codes: DataFrame, classes: DataFrame) -> DataFrame:
    """Readable label per feature from the code file (DETBL_) and class file (MEDTBL_).

    DETBL_F11_2 -> code 'F11.2'; a one-part name DETBL_F11 -> 'F11.' (the
    code file always has a dot after the third character). Unmatched names
    keep the feature name.
    """
    f = long_df.select("feature").distinct()
    parts = F.split(F.col("feature"), "_")
    icd = F.when(F.size(parts) > 2, F.concat(parts[1], F.lit("."), parts[2])).otherwise(F.concat(parts[1], F.lit(".")))
    f = f.withColumn("_icd", F.when(F.col("feature").startswith("DETBL_"), icd)).withColumn(
        "_atc", F.when(F.col("feature").startswith("MEDTBL_"), parts[1]))
    f = f.join(codes.select(F.col("code").alias("_icd"), F.col("description")), "_icd", "left")
    f = f.join(classes.select(F.col("code").alias("_atc"), F.col("label")), "_atc", "left")
    readable = (F.when(F.col("description").isNotNull(), F.concat(F.lit("DETBL_"), F.col("description")))
                 .when(F.col("label").isNotNull(), F.concat(F.lit("MEDTBL_"), F.col("label")))
                 .otherwise(F.col("feature")))
    return f.select("feature", readable.alias("readable"))
