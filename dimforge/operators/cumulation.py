"""Cumulative dimensions: period-over-period snapshots with a history array."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.operators.common import cols, full_outer_step, tier
from dimforge.operators.published import MissingPeriodError, PublishedTable  # noqa: F401

# fixed values: class labels, best first (the last one is the default)
LABELS = ("star", "good", "average", "bad")


def cumulate_step(prev: DataFrame, today: DataFrame, key: str, period_col: str, period: int,
                  struct_cols: Sequence[str], static_cols: Sequence[str], metric: str,
                  thresholds: Sequence[float], history: str = "seasons",
                  class_col: str = "scoring_class") -> DataFrame:
    """One period of a cumulative table.

    ``prev`` is the snapshot stamped ``period - 1`` (columns: key, statics,
    history array, class, years_since_last_active, is_active, current_<p>),
    ``today`` has at most one row per key for ``period``. Static attributes are
    carried (today's value first), today's struct is appended to the history,
    the class comes from today's metric or is carried, and the snapshot is
    stamped ``period``. The join is one shuffle on the key.
    """
    cur = f"current_{period_col}"
    y = prev.filter(F.col(cur) == period - 1)
    t = today.filter(F.col(period_col) == period)
    j, keyc = full_outer_step(y, t, key)
    present = F.col(f"t.{period_col}").isNotNull()
    new_item = F.struct(*[F.col(f"t.{c}").alias(c) for c in struct_cols])
    hist = F.concat(F.coalesce(F.col(f"y.{history}"), F.array().cast(y.schema[history].dataType)),
                    F.when(present, F.array(new_item)).otherwise(F.array().cast(y.schema[history].dataType)))
    return j.select(
        *keyc,
        *[F.coalesce(F.col(f"t.{c}"), F.col(f"y.{c}")).alias(c) for c in static_cols],
        hist.alias(history),
        F.when(present, tier(F.col(f"t.{metric}"), thresholds, LABELS))
         .otherwise(F.col(f"y.{class_col}")).alias(class_col),
        F.when(present, F.lit(0))
         .otherwise(F.coalesce(F.col("y.years_since_last_active"), F.lit(0)) + 1).alias("years_since_last_active"),
        present.alias("is_active"),
        F.lit(period).alias(cur))


def empty_snapshot(today: DataFrame, key: str, period_col: str, struct_cols: Sequence[str],
                   static_cols: Sequence[str], history: str = "seasons",
                   class_col: str = "scoring_class") -> DataFrame:
    """A zero-row snapshot with the schema ``cumulate_step`` expects as ``prev``."""
    st = F.struct(*[F.col(c) for c in struct_cols])
    return today.limit(0).select(
        key, *static_cols, F.array(st).alias(history), F.lit(None).cast("string").alias(class_col),
        F.lit(0).alias("years_since_last_active"), F.lit(False).alias("is_active"),
        F.lit(0).alias(f"current_{period_col}"))


def cumulate_backfill(facts: DataFrame, key: str, period_col: str, hi: int,
                      struct_cols: Sequence[str], static_cols: Sequence[str], metric: str,
                      thresholds: Sequence[float], history: str = "seasons",
                      class_col: str = "scoring_class") -> DataFrame:
    """Every snapshot from each entity's first period up to ``hi`` in one pass.

    Spine = explode(sequence(first, hi)) per entity (no range join), left join
    to the facts, running ``collect_list`` (nulls skipped) over the entity's
    periods. Window partitions are entity histories, bounded by the number of
    periods. Equal to chaining ``cumulate_step`` from each first period.
    """
    f = facts.filter(F.col(period_col) <= hi)
    first = f.groupBy(key).agg(F.min(period_col).alias("_first"),
                               *[F.max(c).alias(c) for c in static_cols])
    spine = first.select(key, *static_cols,
                         F.explode(F.sequence(F.col("_first"), F.lit(hi))).alias(period_col))
    item = F.struct(*[F.col(f"_f.{c}").alias(c) for c in struct_cols])
    j = (spine.alias("_s")
         .join(f.select(key, period_col, *struct_cols).alias("_f"),
               [F.col(f"_s.{key}") == F.col(f"_f.{key}"),
                F.col(f"_s.{period_col}") == F.col(f"_f.{period_col}")], "left")
         .select(F.col(f"_s.{key}").alias(key), *[F.col(f"_s.{c}").alias(c) for c in static_cols],
                 F.col(f"_s.{period_col}").alias(period_col),
                 F.when(F.col(f"_f.{period_col}").isNotNull(), item).alias("_item")))
    w = Window.partitionBy(key).orderBy(period_col).rowsBetween(Window.unboundedPreceding, 0)
    h = j.withColumn(history, F.collect_list("_item").over(w))
    last = F.element_at(F.col(history), -1)
    return h.select(
        key, *static_cols, history,
        tier(last[metric], thresholds, LABELS).alias(class_col),
        (F.col(period_col) - last[period_col]).alias("years_since_last_active"),
        (last[period_col] == F.col(period_col)).alias("is_active"),
        F.col(period_col).alias(f"current_{period_col}"))


def cumulate_snapshot(facts: DataFrame, key: str, period_col: str, period: int, struct_cols: Sequence[str],
                      static_cols: Sequence[str], metric: str, thresholds: Sequence[float],
                      history: str = "seasons", class_col: str = "scoring_class") -> DataFrame:
    """The snapshot of one period: ``cumulate_backfill`` for that period alone.

    One aggregation gathers each entity's history up to ``period`` (bounded by
    the number of periods); no other period's list is built.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col(period_col).alias("_p"), F.struct(*struct_cols).alias("_item"))))
    h = (facts.filter(F.col(period_col) <= period).groupBy(key)
              .agg(*[F.max(c).alias(c) for c in static_cols], items.alias("_items")))
    h = h.withColumn(history, F.col("_items._item")).withColumn("_last", F.element_at("_items", -1))
    return h.select(
        key, *static_cols, history,
        tier(F.col(f"_last._item.{metric}"), thresholds, LABELS).alias(class_col),
        (F.lit(period) - F.col("_last._p")).alias("years_since_last_active"),
        (F.col("_last._p") == period).alias("is_active"),
        F.lit(period).alias(f"current_{period_col}"))


def cumulate_step_multi(prev: DataFrame, today: DataFrame, key: str, period_col: str, period: int,
                        order_col: str, struct_cols: Sequence[str], static_cols: Sequence[str],
                        metric: str, thresholds: Sequence[float], history: str = "films",
                        class_col: str = "quality_class") -> DataFrame:
    """Like ``cumulate_step`` but today has many rows per entity.

    Today is pre-aggregated first (one shuffle, partial aggregation map-side):
    sorted struct list by ``order_col`` and the mean metric for the class.
    """
    t = (today.filter(F.col(period_col) == period)
              .groupBy(key)
              .agg(*[F.max(c).alias(c) for c in static_cols],
                   F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in [order_col] +
                                                          [x for x in struct_cols if x != order_col]]))).alias("_new"),
                   F.avg(metric).alias("_avg"),
                   F.lit(period).alias(period_col)))
    cur = f"current_{period_col}"
    y = prev.filter(F.col(cur) == period - 1)
    j, keyc = full_outer_step(y, t, key)
    present = F.col(f"t.{period_col}").isNotNull()
    htype = y.schema[history].dataType
    new = F.transform(F.col("t._new"), lambda s: F.struct(*[s[c].alias(c) for c in struct_cols]))
    return j.select(
        *keyc,
        *[F.coalesce(F.col(f"t.{c}"), F.col(f"y.{c}")).alias(c) for c in static_cols],
        F.concat(F.coalesce(F.col(f"y.{history}"), F.array().cast(htype)),
                 F.coalesce(new.cast(htype), F.array().cast(htype))).alias(history),
        F.when(present, tier(F.col("t._avg"), thresholds, LABELS))
         .otherwise(F.col(f"y.{class_col}")).alias(class_col),
        present.alias("is_active"),
        F.lit(period).alias(cur))


def empty_multi_snapshot(today: DataFrame, key: str, period_col: str, struct_cols: Sequence[str],
                         static_cols: Sequence[str], history: str = "films",
                         class_col: str = "quality_class") -> DataFrame:
    st = F.struct(*[F.col(c) for c in struct_cols])
    return today.limit(0).select(
        key, *static_cols, F.array(st).alias(history), F.lit(None).cast("string").alias(class_col),
        F.lit(False).alias("is_active"), F.lit(0).alias(f"current_{period_col}"))


def first_last_ratio(snapshot: DataFrame, history: str, field: str, name: str = "ratio") -> DataFrame:
    """Latest element's field over the first element's; zero denominator -> 1. Row-local."""
    first = F.try_element_at(F.col(history), F.lit(1))[field]
    last = F.try_element_at(F.col(history), F.lit(-1))[field]
    den = F.when(first == 0, F.lit(1.0)).otherwise(first)
    return snapshot.withColumn(name, F.try_divide(last, den))


def history_explode(snapshot: DataFrame, keep: Sequence[str], history: str) -> DataFrame:
    """One row per history element (struct fields become columns)."""
    return snapshot.select(*keep, F.inline(F.col(history)))


def latest_state(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """Newest row per entity, as an aggregation (``max_by``) rather than a window."""
    keys = cols(key)
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order)).alias("_last"))
              .select(*keys, "_last.*"))


def cumulate_chain_guard(chain: PublishedTable, period: int, first_period: int) -> None:
    """Refuse to build ``period`` when the predecessor snapshot is absent.

    ``depends_on_past``: unless ``period`` is the first of the chain, ``period
    - 1`` must be published. The manifest answers; no job is run.
    """
    if period != first_period:
        chain.require(period - 1)


def enum_violations(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is outside ``allowed`` (NULL counts as outside)."""
    return df.filter(~F.coalesce(F.col(col).isin(*allowed), F.lit(False)))


def enforce_enum(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Pass-through that fails the write task on the first value outside ``allowed``."""
    ok = F.coalesce(F.col(col).isin(*allowed), F.lit(False))
    return df.withColumn(col, F.when(ok, F.col(col)).otherwise(
        F.raise_error(F.concat(F.lit(f"{col} outside allowed values: "), F.coalesce(F.col(col), F.lit("NULL"))))
        .cast("string")))
