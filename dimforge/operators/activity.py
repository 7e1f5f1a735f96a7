"""Cumulated activity: date lists, date-list bitmaps, reduced monthly arrays, dimension flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.functions.columns import MASK_LAST_7, MASK_PREV_7, WINDOW_DAYS, datelist_bits  # noqa: F401
from dimforge.operators.common import cols
from dimforge.operators.published import PublishedTable, previous



def day_of(ts: str) -> Column:
    return F.to_date(F.col(ts))


def daily_activity(events: DataFrame, key: str | Sequence[str], ts: str, ds: str | None = None) -> DataFrame:
    """(key, date, n_events) for non-null keys; one day only when ``ds`` is given.

    A single-day filter is written as a half-open timestamp range so it
    reaches the parquet scan as a pushed filter instead of wrapping the
    column in ``to_date``.
    """
    keys = cols(key)
    e = events
    for k in keys:
        e = e.filter(F.col(k).isNotNull())
    if ds is not None:
        lo = F.lit(ds).cast("date").cast("timestamp_ntz")
        e = e.filter((F.col(ts) >= lo) & (F.col(ts) < F.date_add(F.lit(ds).cast("date"), 1).cast("timestamp_ntz")))
    return e.groupBy(*keys, day_of(ts).alias("date")).agg(F.count(F.lit(1)).alias("n_events"))


def dates_active_step(prev: DataFrame | PublishedTable, events: DataFrame, key: str, ts: str, ds: str,
                      dates: str = "dates_active") -> DataFrame:
    """users_cumulated for ``ds`` = yesterday's row FULL OUTER today's activity.

    Today's date is appended when active; the row is stamped
    ``coalesce(today, yesterday + 1)``. A published chain (``prev``) that has
    no yesterday is refused.
    """
    y = previous(prev, "date", ds).alias("y")
    t = daily_activity(events, key, ts, ds).alias("t")
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full_outer")
    empty = F.array().cast("array<date>")
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.concat(F.coalesce(F.col(f"y.{dates}"), empty),
                 F.when(F.col("t.date").isNotNull(), F.array(F.col("t.date"))).otherwise(empty)).alias(dates),
        F.coalesce(F.col("t.date"), F.date_add(F.col("y.date"), 1)).alias("date"))


def dates_active_backfill(events: DataFrame, key: str | Sequence[str], ts: str, ds: str,
                          dates: str = "dates_active") -> DataFrame:
    """Same rows as chaining ``dates_active_step`` up to ``ds``, in one aggregation."""
    keys = cols(key)
    e = events
    for k in keys:
        e = e.filter(F.col(k).isNotNull())
    e = e.filter(F.col(ts) < F.date_add(F.lit(ds).cast("date"), 1).cast("timestamp_ntz"))
    return (e.groupBy(*keys).agg(F.array_sort(F.collect_set(day_of(ts))).alias(dates))
             .withColumn("date", F.lit(ds).cast("date")))


def datelist_flags(df: DataFrame, bits: str = "datelist_int") -> DataFrame:
    b = F.col(bits)
    last7 = F.bit_count(b.bitwiseAND(F.lit(MASK_LAST_7).cast("bigint")))
    prev7 = F.bit_count(b.bitwiseAND(F.lit(MASK_PREV_7).cast("bigint")))
    return df.select(
        "*",
        (F.bit_count(b) > 0).alias("dim_is_monthly_active"),
        F.bit_count(b).cast("int").alias("l32"),
        (last7 > 0).alias("dim_is_weekly_active"),
        last7.cast("int").alias("l7"),
        (prev7 > 0).alias("dim_is_weekly_active_previous_week"))


def month_start_of(ds: str) -> Column:
    return F.trunc(F.lit(ds).cast("date"), "month")


def _daily_map(events: DataFrame, keys: list[str], ts: str, ds: str, metric: Column) -> DataFrame:
    """Per key: map(day offset -> metric) for the month of ``ds`` up to ``ds``."""
    ms = month_start_of(ds)
    e = events
    for k in keys:
        e = e.filter(F.col(k).isNotNull())
    e = e.filter((F.col(ts) >= ms.cast("timestamp_ntz")) &
                 (F.col(ts) < F.date_add(F.lit(ds).cast("date"), 1).cast("timestamp_ntz")))
    daily = e.groupBy(*keys, F.datediff(day_of(ts), ms).alias("_off")).agg(metric.alias("_m"))
    return daily.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_off", "_m"))).alias("_by_day"))


def metric_array_backfill(events: DataFrame, key: str | Sequence[str], ts: str, ds: str,
                          metric: Column | None = None, fill: Column | str | None = "zero",
                          name: str = "metric_array") -> DataFrame:
    """Month-to-date array per key: element i = metric on day i of the month (``fill`` when absent).

    Row count per key is bounded by the days of a month; the per-key map is
    built from a daily aggregate, so the raw events are combined map-side.
    """
    keys = cols(key)
    metric = metric if metric is not None else F.count(F.lit(1))
    if isinstance(fill, str):
        fill = F.lit(0).cast("bigint")
    m = _daily_map(events, keys, ts, ds, metric)
    n = F.datediff(F.lit(ds).cast("date"), month_start_of(ds))
    arr = F.transform(F.sequence(F.lit(0), n),
                      lambda i: F.coalesce(F.element_at(F.col("_by_day"), i), fill) if fill is not None
                      else F.element_at(F.col("_by_day"), i))
    return m.select(*keys, month_start_of(ds).alias("month_start"), arr.alias(name))


def until_day(arr: Column, n: Column, fill: Column) -> Column:
    """``arr`` as exactly ``n`` elements: cut, or filled up with ``fill``; NULL counts as empty."""
    fill = fill.cast("bigint")
    return F.transform(F.filter(F.sequence(F.lit(0), n), lambda i: i < n),
                       lambda i: F.coalesce(F.get(arr, i).cast("bigint"), fill))


def metric_array_step(prev: DataFrame, events: DataFrame, key: str, ts: str, ds: str,
                      metric_name: str = "site_hits") -> DataFrame:
    """Put today's count (0 when absent) on its day of the month.

    A shorter predecessor (a missed day, a key first seen today) is filled
    with zeros up to yesterday, one that holds today already (a rerun) is cut
    before it, so each value stands on its own day.
    """
    ms = month_start_of(ds)
    y = prev.filter((F.col("month_start") == ms) & (F.col("metric_name") == metric_name)).alias("y")
    t = daily_activity(events, key, ts, ds).alias("t")
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full_outer")
    today = F.array(F.coalesce(F.col("t.n_events"), F.lit(0)).cast("bigint"))
    n = F.datediff(F.lit(ds).cast("date"), ms)
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.coalesce(F.col("y.month_start"), ms).alias("month_start"),
        F.lit(metric_name).alias("metric_name"),
        F.concat(until_day(F.col("y.metric_array"), n, F.lit(0)), today).alias("metric_array"))


def hit_array_step(prev: DataFrame, events: DataFrame, key: str, ts: str, ds: str) -> DataFrame:
    """NULL-filled month array; ``first_found_date`` kept for keys absent today (``least`` skips NULL).

    The predecessor is the newest partition of the same month before ``ds``:
    a new month starts afresh, a missed day is filled with NULL, a rerun of
    ``ds`` never reads its own result.
    """
    ms = month_start_of(ds)
    older = prev.filter((F.col("month_start") == ms) & (F.col("date_partition") < F.lit(ds).cast("date")))
    y = older.groupBy(key).agg(F.max_by(F.struct("hit_array", "first_found_date"), "date_partition").alias("_p"))
    y = y.select(key, "_p.hit_array", "_p.first_found_date").alias("y")
    t = daily_activity(events, key, ts, ds).alias("t")
    j = y.join(t, F.col(f"y.{key}") == F.col(f"t.{key}"), "full_outer")
    n = F.datediff(F.lit(ds).cast("date"), ms)
    return j.select(
        F.coalesce(F.col(f"t.{key}"), F.col(f"y.{key}")).alias(key),
        F.concat(until_day(F.col("y.hit_array"), n, F.lit(None)), F.array(F.col("t.n_events").cast("bigint"))).alias("hit_array"),
        ms.alias("month_start"),
        F.least(F.col("y.first_found_date"), F.col("t.date")).alias("first_found_date"),
        F.lit(ds).cast("date").alias("date_partition"))


def hit_array_backfill(events: DataFrame, key: str, ts: str, ds: str) -> DataFrame:
    """Same rows as chaining ``hit_array_step`` from the month start to ``ds``."""
    a = metric_array_backfill(events, key, ts, ds, fill=None, name="hit_array")
    ms = month_start_of(ds)
    first = F.array_position(F.transform("hit_array", lambda x: x.isNotNull()), F.lit(True))
    return a.select(key, "hit_array", "month_start",
                    F.date_add(ms, (first - 1).cast("int")).alias("first_found_date"),
                    F.lit(ds).cast("date").alias("date_partition"))


def metric_array_unpivot(df: DataFrame, arr: str = "metric_array") -> DataFrame:
    """Sum each array position over all keys, then one row per day (month_start + position).

    ``posexplode`` then a grouped sum: partial aggregation keeps the shuffle at
    (metric, month, day) granularity whatever the number of keys.
    """
    return (df.select("metric_name", "month_start", F.posexplode(arr).alias("pos", "v"))
              .groupBy("metric_name", "month_start", "pos").agg(F.sum("v").alias("value"))
              .select("metric_name", F.date_add("month_start", F.col("pos")).alias("adjusted_date"), "value"))


def metric_array_pick(df: DataFrame, arr: str, positions: Sequence[int], names: Sequence[str],
                      ds: str | None = None, part: str = "date_partition") -> DataFrame:
    """Sum of chosen 0-based positions per month; absent or NULL elements count 0."""
    d = df if ds is None else df.filter(F.col(part) == F.lit(ds).cast("date"))
    return d.groupBy("month_start").agg(
        *[F.sum(F.coalesce(F.get(F.col(arr), i), F.lit(0))).alias(n) for i, n in zip(positions, names)])


def metric_array_cardinality(df: DataFrame, arr: str = "metric_array") -> DataFrame:
    return df.groupBy(F.size(arr).alias("cardinality")).agg(F.count(F.lit(1)).alias("n_rows"))


def dim_ever_flags(events: DataFrame, key: str, ts: str, ds: str, type_col: str,
                   ever: Sequence[str], signup: str = "signup") -> DataFrame:
    d0 = F.lit(ds).cast("date")
    e = events.filter(F.col(key).isNotNull() &
                      (F.col(ts) < F.date_add(d0, 1).cast("timestamp_ntz")))
    return e.groupBy(key).agg(
        *[F.bool_or(F.col(type_col) == t).alias(f"has_ever_{t}") for t in ever],
        F.datediff(d0, F.max(day_of(ts))).alias("days_since_last_active"),
        F.datediff(d0, F.min(F.when(F.col(type_col) == signup, day_of(ts)))).alias("days_since_signup"))


def dim_state_vs_activity(events: DataFrame, key: str, ts: str) -> DataFrame:
    """Per day: users activated so far (a state) beside users active that day (an activity).

    Both come from per-day aggregates; the running sum runs over the
    day-level table (one row per calendar day), never over raw events.
    """
    e = events.filter(F.col(key).isNotNull())
    active = e.groupBy(day_of(ts).alias("date")).agg(F.countDistinct(key).alias("active_users"))
    firsts = (e.groupBy(key).agg(F.min(day_of(ts)).alias("date"))
               .groupBy("date").agg(F.count(F.lit(1)).alias("new_users")))
    days = active.join(firsts, "date", "left").fillna(0, ["new_users"])
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("date", "active_users",
                       F.sum("new_users").over(w).alias("activated_users"))


def visitor_bitmaps(events: DataFrame, keys: Sequence[str], ts: str, ident: str) -> DataFrame:
    """Who was there, per (keys, day): exact sets of ids that can be merged.

    An id is one bit in the bitmap of its bucket (32,768 ids), so a set is a
    few rows of at most 4 KB, built with map-side combine. Unlike counts of
    distinct ids, the rows add up over days and keys: see ``visitors``.
    """
    e = events.filter(F.col(ident).isNotNull())
    return (e.groupBy(*keys, day_of(ts).alias("date"), F.bitmap_bucket_number(ident).alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ident)).alias("bitmap")))


def visitors(bitmaps: DataFrame, by: Sequence[str | Column], name: str = "visitors") -> DataFrame:
    """Distinct ids per ``by`` from stored bitmaps: OR per bucket, then add up the bits."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("_b"))
    groups = [c for c in merged.columns if c not in ("bucket", "_b")]
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("_b")).alias(name))


def additivity_check(df: DataFrame, dim: str, ident: str) -> DataFrame:
    """Is sum over groups of distinct ids equal to distinct ids overall?

    Distinct (group, id) pairs, then per id the number of groups it falls
    in: the dimension is additive exactly when every id is in one group.
    """
    pairs = df.filter(F.col(ident).isNotNull()).select(dim, ident).distinct()
    per_id = pairs.groupBy(ident).agg(F.count(F.lit(1)).alias("_g"))
    return (per_id.agg(F.sum("_g").alias("sum_group_distinct"), F.count(F.lit(1)).alias("overall_distinct"))
                  .withColumn("is_additive", F.col("sum_group_distinct") == F.col("overall_distinct")))
