"""Joins (J1-J16).

Design notes for scale:

* Equi keys are always present, so range conditions (payer periods, prior
  visits, active conditions) are residuals of a hash/sort-merge join - never
  a Cartesian or nested-loop product.
* Full outer joins cannot be broadcast and AQE cannot split their skewed
  partitions. ``full_outer_join`` therefore rewrites ``A FULL JOIN B`` as
  ``A LEFT JOIN B  UNION ALL  (B anti-join distinct keys of A)``: the left
  join may broadcast B (when Spark's size estimate allows) or be split by AQE
  when one key is hot, and the anti join reads only the pre-aggregated key
  set of A (partial aggregation collapses a hot key before the shuffle).
* No explicit broadcast hint is put on tables that grow with the data; Spark's
  ``autoBroadcastJoinThreshold`` and AQE's runtime statistics decide, and a
  sort-merge join is the fallback above the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_parquet_table


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def dealt(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """``df`` dealt by ``keys`` into ``partitions`` (default: the session's), which adaptive execution leaves as many.

    Adaptive execution packs partitions up to a number of compressed bytes.
    Long tables of few distinct values hold many times that in the sort or
    aggregate of a task, so a task's memory is set by how well they compress.
    Two sides dealt alike join without a further shuffle. A hot key is one
    task's, whose sort spills; joins that expect one are left to AQE.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def full_outer_join(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                    key_source: DataFrame | None = None) -> DataFrame:
    """``left FULL OUTER JOIN right USING (on)``, skew-safe form.

    Result columns: keys, then left's other columns, then right's other
    columns (the order of ``DataFrame.join(..., 'full')`` with a USING list).
    Keys are coalesced as in a USING join.

    ``key_source`` is an optional frame with the same set of non-null keys
    as ``left`` that is cheaper to read (typically the table the key column
    of ``left`` came from). The orphan rows of ``right`` are then found
    against it, so ``left``'s own plan is not computed a second time for
    its key set.
    """
    keys = _keys(on)
    matched = left.join(right, on=keys, how="left")
    left_keys = (key_source if key_source is not None else left).select(*keys).where(
        reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).distinct()
    orphans = right.join(left_keys, on=keys, how="left_anti")
    missing = [c for c in left.columns if c not in keys]
    orphans = orphans.select(
        *keys,
        *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in missing],
        *[c for c in right.columns if c not in keys],
    )
    return matched.unionByName(orphans)


def join_tables(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Generic USING join; ``how='full'`` goes through ``full_outer_join``."""
    if how in ("full", "outer", "full_outer", "fullouter"):
        return full_outer_join(left, right, on)
    return left.join(right, on=_keys(on), how=how)


DEFAULT_BIN_DAYS = 91
# Bin of events whose start lies after their end: they meet every period of
# their key (see ``interval_join``).
_ODD_BIN = -(2 ** 62)


def _day_bin(c: Column, bin_days: int) -> Column:
    return F.floor(F.unix_date(F.to_date(c)) / F.lit(float(bin_days))).cast("bigint")


def interval_join(
    events: DataFrame,
    periods: DataFrame,
    key: str = "person_id",
    event_start: str = "visit_start_datetime",
    event_end: str = "visit_end_datetime",
    period_start: str = "payer_plan_period_start_date",
    period_end: str = "payer_plan_period_end_date",
    strict: bool = False,
    bin_days: int | None = DEFAULT_BIN_DAYS,
) -> DataFrame:
    """Events whose [start, end] lies inside a period of the same key.

    Periods are dates and event times are timestamps: by default the event
    end is compared as a date, so a visit ending at 08:00 on the period's
    last day is inside (D4). ``strict=True`` compares the timestamp with the
    date's midnight instead.

    Plan: an equi join with a range residual, never a Cartesian product. A
    plain equi join on ``key`` compares every event of a key with every
    period of that key, which is quadratic for a key holding a large share
    of both tables. With ``bin_days`` the time axis is cut into bins: each
    period is repeated once per bin it covers, each event carries the bin of
    its start day, and the equi key becomes ``(key, bin)``. An event inside
    a period has its start day inside the period, so it meets that period in
    exactly one bin (no duplicates) and only meets the periods overlapping
    its own bin. Period bins are clipped to the bin range of the events (one
    small aggregate over the event start column), so open-ended periods
    (far-future end dates) do not multiply rows. Events whose start day is
    after their end day can match periods that do not contain their start;
    they get one shared bin that every period also carries, which keeps the
    result exact. ``bin_days=None`` gives the plain equi join.
    """
    other_cols = [c for c in periods.columns if c != key]
    if bin_days:
        ok = F.to_date(F.col(event_start)) <= F.to_date(F.col(event_end))
        ebin = F.when(ok, _day_bin(F.col(event_start), bin_days)).when(~ok, F.lit(_ODD_BIN))
        events = events.withColumn("_bin", ebin)
        rng = events.where(F.col("_bin") != F.lit(_ODD_BIN)).agg(
            F.struct(F.min("_bin").alias("lo"), F.max("_bin").alias("hi"))).scalar()
        # The range subquery is referenced once, so it runs once.
        clip = periods.select("*", rng.alias("_rng"))
        # Without any valid event the range is null, and periods need no bins.
        clip = clip.select(*periods.columns, F.col("_rng.lo").isNotNull().alias("_any"),
                           F.greatest(_day_bin(F.col(period_start), bin_days), F.col("_rng.lo")).alias("_lo"),
                           F.least(_day_bin(F.col(period_end), bin_days), F.col("_rng.hi")).alias("_hi"))
        lo, hi = F.col("_lo"), F.col("_hi")
        bins = F.concat(F.coalesce(F.when(F.col("_any") & (lo <= hi), F.sequence(lo, hi)), F.array().cast("array<bigint>")),
                        F.array(F.lit(_ODD_BIN)))
        periods = clip.select(*periods.columns, F.explode(bins).alias("_bin"))
    e, p = events.alias("e"), periods.alias("p")
    end = F.col(f"e.{event_end}") if strict else F.to_date(F.col(f"e.{event_end}"))
    cond = (
        (F.col(f"e.{key}") == F.col(f"p.{key}"))
        & (F.col(f"e.{event_start}") >= F.col(f"p.{period_start}"))
        & (end <= F.col(f"p.{period_end}"))
    )
    if bin_days:
        cond = cond & (F.col("e._bin") == F.col("p._bin"))
    keep = [F.col(f"e.{c}") for c in events.columns if c != "_bin"]
    return e.join(p, cond, "inner").select(*keep, *[F.col(f"p.{c}") for c in other_cols])


def latest_per_key(df: DataFrame, key: str = "person_id", order_col: str = "payer_plan_period_start_date") -> DataFrame:
    """Rows holding the latest ``order_col`` of their key; ties kept.

    The maximum per key is a ``groupBy`` (partial aggregation, so a key that
    holds a third of all rows is one row per map task before the shuffle);
    the rows are then kept by a left-semi join on key *and* date (D2), which
    AQE can split when one key is hot.
    """
    latest = df.groupBy(key).agg(F.max(order_col).alias(order_col))
    return df.join(latest, on=[key, order_col], how="left_semi")


def decode(df: DataFrame, concept: DataFrame, key: str, concept_key: str = "concept_id",
           concept_cols: Sequence[str] | None = None, how: str = "inner") -> DataFrame:
    """Look up vocabulary columns for a code column.

    The concept side is projected to the columns needed before the join, so
    the broadcast (chosen by Spark from its size estimate) carries only them.
    """
    cols = list(concept_cols) if concept_cols is not None else [c for c in concept.columns if c != concept_key]
    lookup = concept.select(F.col(concept_key).alias(key), *cols)
    return df.join(lookup, on=key, how=how)


def prior_visits(visits: DataFrame, index: DataFrame, key: str = "person_id",
                 visit_id: str = "visit_occurrence_id", end_col: str = "visit_end_datetime") -> DataFrame:
    """Visits of index persons that end no later than one of their index visits.

    The result is the set of such visits ``(person_id, visit_occurrence_id)``.
    "No later than *some* index visit" equals "no later than the person's
    latest index visit", so the index side is first reduced to one row per
    person (``max`` with partial aggregation) and the self join becomes an
    equi join on ``key`` with a ``<=`` residual against that single bound:
    linear in the number of visits, no pairs of visits are formed.
    """
    bound = (visits.join(index.select(visit_id), on=visit_id, how="left_semi")
                   .groupBy(key).agg(F.max(end_col).alias("_bound")))
    return (visits.select(key, visit_id, end_col)
                  .join(bound, on=key, how="inner")
                  .where(F.col(end_col) <= F.col("_bound"))
                  .select(key, visit_id)
                  .distinct())


def active_at_visit(conditions: DataFrame, visits: DataFrame, visit_id: str = "visit_occurrence_id",
                    start_col: str = "condition_start_datetime", end_col: str = "condition_end_datetime",
                    visit_start: str = "visit_start_datetime", open_ended: bool = False,
                    visit_cols: Sequence[str] = ("person_id",), scope: str = "visit", person: str = "person_id",
                    bin_days: int = DEFAULT_BIN_DAYS) -> DataFrame:
    """Conditions that started before a visit's start and end after it.

    ``scope='visit'``: conditions recorded at the visit itself, an equi join on
    the visit id with a range residual. ``scope='person'`` (D25): conditions of
    the person, whichever visit they were recorded at (``recorded_visit_id``),
    against every visit of that person. A null end drops the row unless
    ``open_ended`` (then the condition counts as still active).

    A person's conditions and visits never meet as pairs: time is cut into
    bins, a condition is repeated once for each bin that it touches, clipped
    to the bins in which there are visits (so an open end costs no more than a
    long one), and a visit start meets the conditions of its own bin.
    """
    if scope not in ("visit", "person"):
        raise ValueError(f"scope must be 'visit' or 'person', got {scope!r}")
    ends_after = F.col(end_col) > F.col(visit_start)
    if open_ended:
        ends_after = ends_after | F.col(end_col).isNull()
    if scope == "visit":
        v = visits.select(visit_id, visit_start, *[c for c in visit_cols if c not in conditions.columns])
        return (conditions.join(v, on=visit_id, how="inner")
                          .where((F.col(start_col) < F.col(visit_start)) & ends_after))
    starts = visits.select(person, visit_id, visit_start, _day_bin(F.col(visit_start), bin_days).alias("_bin")).where(
        F.col("_bin").isNotNull())
    rng = starts.agg(F.struct(F.min("_bin").alias("lo"), F.max("_bin").alias("hi"))).scalar()
    last = _day_bin(F.col(end_col), bin_days)
    if open_ended:
        last = F.when(F.col(end_col).isNull(), F.col("_rng.hi")).otherwise(last)
    spans = conditions.withColumnRenamed(visit_id, "recorded_visit_id").withColumn("_rng", rng).withColumns({
        "_lo": F.greatest(_day_bin(F.col(start_col), bin_days), F.col("_rng.lo")), "_hi": F.least(last, F.col("_rng.hi"))})
    # Null bounds (no visit, no start, or an end that drops the row) leave no bin.
    spans = spans.where((F.col("_lo") <= F.col("_hi")) & F.col(start_col).isNotNull())
    if not open_ended:
        spans = spans.where(F.col(end_col).isNotNull())
    binned = spans.withColumn("_bin", F.explode(F.sequence("_lo", "_hi"))).drop("_rng", "_lo", "_hi")
    met = dealt(binned, person, "_bin").join(dealt(starts, person, "_bin"), [person, "_bin"], "inner")
    return met.where((F.col(start_col) < F.col(visit_start)) & ends_after).drop("_bin")


def full_outer_join_many(frames: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """``f1 FULL JOIN f2 FULL JOIN ... USING (on)`` for any number of frames.

    Nesting the two-frame rewrite would read every earlier frame twice per
    level (once for its rows, once for its key set), so the plan would
    double with each frame. Here the key set of all frames is built once
    (union of the key columns, one ``distinct``) and every frame is
    left-joined onto it: for a key present anywhere, the rows are the
    product of each frame's matches (or one null row), exactly as in the
    chained full joins. Rows whose key has a null never match, so each of
    them is appended once with the other frames' columns null. Each frame
    is read three times (key set, rows, null-key rows), whatever the number
    of frames.
    """
    frames, keys = list(frames), _keys(on)
    full_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key_set = reduce(lambda a, b: a.unionByName(b), [f.select(*keys).where(full_key) for f in frames]).distinct()
    out = reduce(lambda a, f: a.join(f, on=keys, how="left"), frames, key_set)
    for f in frames:
        out = out.unionByName(f.where(~full_key), allowMissingColumns=True)
    return out


def join_frames(frames: Sequence[DataFrame], on: str | Sequence[str], how: str = "left") -> DataFrame:
    """N-way join of frames on one or more keys (left by default).

    Full outer joins of more than two frames go through ``full_outer_join_many``.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("join_frames needs at least one frame")
    if how in ("full", "outer", "full_outer", "fullouter") and len(frames) > 2:
        return full_outer_join_many(frames, on)
    return reduce(lambda a, b: join_tables(a, b, on, how), frames[1:], frames[0])


def join_all(frames: dict[str, DataFrame], column: str, how: str = "full") -> DataFrame:
    """Join every named frame that has ``column``; clashing columns get a table prefix.

    Tables without the column are skipped. With no table left, raises. Rows
    of one key in several tables are paired with each other, as joins do.
    """
    chosen = {n: df for n, df in frames.items() if column in df.columns}
    if not chosen:
        raise ValueError(f"no table has column {column!r}")
    counts: dict[str, int] = {}
    for df in chosen.values():
        for c in df.columns:
            if c != column:
                counts[c] = counts.get(c, 0) + 1
    renamed = []
    for name, df in chosen.items():
        renamed.append(df.select(*[
            F.col(c) if c == column or counts[c] == 1 else F.col(c).alias(f"{name}_{c}") for c in df.columns
        ]))
    return join_frames(renamed, column, how)


def join_paths(spark: SparkSession, paths: Sequence[str], on: str | Sequence[str], how: str = "left") -> DataFrame:
    """N-way join of parquet folders, in the order given."""
    return join_frames([read_parquet_table(spark, p) for p in paths], on, how)


def join_tables_with(spark: SparkSession, base: str, column: str, tables: Sequence[str], how: str = "full") -> DataFrame:
    """J10 from a folder: of the named tables under ``base``, those with ``column`` (by their schemas) are joined.

    As in ``join_all`` every pairing of a key's rows is kept, so several
    one-to-many tables multiply per key.
    """
    frames = {t: read_parquet_table(spark, f"{base}/{t}") for t in tables}
    return join_all({t: f for t, f in frames.items() if column in f.columns}, column, how)
