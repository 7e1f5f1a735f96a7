"""Building blocks shared by the jobs: dedupe, streaks, full-outer steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.functions.columns import tier  # noqa: F401  (re-exported for the operators)


def cols(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def dedup_first(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Keep one row per key: the smallest by ``order``, ties broken by every other column.

    Written as ``row_number() == 1`` over a total order: Spark plans a
    partial ``WindowGroupLimit`` before the shuffle, so each map task keeps
    only its best row per key and a hot key with many copies never ships
    whole to one task (the same effect as a map-side partial aggregate).
    """
    keys, order = cols(keys), cols(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order + rest])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def changed(col: str, w: Window) -> Column:
    """True when ``col`` differs (null-safe) from the previous row, or there is none."""
    prev = F.lag(F.col(col), 1).over(w)
    first = F.row_number().over(w) == 1
    return first | ~prev.eqNullSafe(F.col(col))


def streak_id(df: DataFrame, key: str | Sequence[str], order: str, tracked: Sequence[str],
              name: str = "streak_id") -> DataFrame:
    """Gaps-and-islands: running count of changes of any tracked column per key."""
    w = Window.partitionBy(*cols(key)).orderBy(order)
    flag = F.lit(False)
    for c in tracked:
        flag = flag | changed(c, w)
    return (df.withColumn("_chg", flag.cast("int"))
              .withColumn(name, F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .drop("_chg"))


def full_outer_step(prev: DataFrame, today: DataFrame, key: str | Sequence[str],
                    prev_alias: str = "y", today_alias: str = "t") -> tuple[DataFrame, list[Column]]:
    """Yesterday FULL OUTER JOIN today on the key.

    Returns the joined frame (sides reachable as ``y.col`` / ``t.col``) and the
    coalesced key columns, today's value first.
    """
    keys = cols(key)
    y, t = prev.alias(prev_alias), today.alias(today_alias)
    cond = [F.col(f"{prev_alias}.{k}") == F.col(f"{today_alias}.{k}") for k in keys]
    j = y.join(t, cond, "full_outer")
    return j, [F.coalesce(F.col(f"{today_alias}.{k}"), F.col(f"{prev_alias}.{k}")).alias(k) for k in keys]


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where NULL matches NULL (``<=>``), keeping one copy of the key columns."""
    r = right.select(*[F.col(c).alias(f"_rk_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = [left[c].eqNullSafe(r[f"_rk_{c}"]) for c in on]
    return left.join(r, cond, how).drop(*[f"_rk_{c}" for c in on])


def sequence_positions(df: DataFrame, key: str | Sequence[str], day: str | Column, tie: Sequence[str],
                       flag: str | None = None) -> DataFrame:
    """Add ``_pos`` (1-based position in the key's (day, tie) order) and, with ``flag``,
    ``_cnt`` (running count of flagged rows up to and including this one).

    ``day`` is any coarse column that is monotone in the order (a date, an
    hour). One window pass over (key, day) gives the rank and running count
    inside the day plus the day totals; the day totals (a table bounded by
    the calendar) get a prefix sum over days and are joined back. No window
    spans all rows of a key, so a key holding a third of the data is still
    spread over many tasks. Window and join use one struct as key (NULLs in it
    compare as equal), so the input is shuffled once; the totals are taken from
    each day's first row, without an aggregation beside the sorted rows.
    """
    keys, names = cols(key), df.columns
    d = df.withColumn("_day", F.col(day) if isinstance(day, str) else day)
    # keys stand in the struct alone, an integer flag in its own column alone: both uses of the
    # rows then read one exchange
    d = d.withColumn("_key", F.struct(*keys, "_day")).drop(*keys, "_day")
    fl = flag if flag is not None and isinstance(df.schema[flag].dataType, T.IntegralType) else "_fl"
    if fl == "_fl":
        d = d.withColumn("_fl", F.lit(0) if flag is None else F.col(flag).cast("int"))
    within = Window.partitionBy("_key").orderBy(*tie)
    whole_day = Window.partitionBy("_key")
    w = (d.withColumn("_r", F.row_number().over(within))
          .withColumn("_cf", F.sum(fl).over(within.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_dn", F.count(F.lit(1)).over(whole_day))
          .withColumn("_df", F.sum(fl).over(whole_day)))
    before = (Window.partitionBy(*[F.col("_key")[k] for k in keys]).orderBy(F.col("_key")["_day"])
              .rowsBetween(Window.unboundedPreceding, -1))
    days = w.filter(F.col("_r") == 1).select("_key", F.coalesce(F.sum("_dn").over(before), F.lit(0)).alias("_n0"),
                                             F.coalesce(F.sum("_df").over(before), F.lit(0)).alias("_f0"))
    out = w.join(days, "_key").select(
        *[F.col("_key")[c].alias(c) if c in keys else F.col(c) for c in names],
        (F.col("_n0") + F.col("_r")).alias("_pos"), (F.col("_f0") + F.col("_cf")).alias("_cnt"))
    return out if flag is not None else out.drop("_cnt")


def number_islands(df: DataFrame, part: Sequence[str], chunk: Column, order: Sequence[str],
                   carry: Sequence[str], starts: Callable[[dict[str, Column], dict[str, Column]], Column],
                   name: str = "_island") -> DataFrame:
    """Gaps and islands without a window over a whole partition.

    Rows are processed in (part, chunk) groups, ``chunk`` being coarse and
    monotone in ``order`` (an hour, a day). Inside a chunk the predecessor
    comes from ``lag``; the first row of a chunk takes the last row of the
    previous chunk from a (part, chunk) aggregate -- a table bounded by the
    number of chunks. ``starts(prev, cur)`` (dicts of the ``carry``
    columns) says whether a row opens a new island; the first row of a
    partition always does. The island number is the running count of
    openings: inside the chunk by window, across chunks by a prefix sum over
    the chunk table. A partition holding a third of all rows is still
    spread over its chunks.
    """
    # one struct as key of windows and joins: NULLs in it compare as equal, and no join moves the rows again
    d = df.withColumn("_key", F.struct(*part, chunk.alias("_chunk")))
    w_in = Window.partitionBy("_key").orderBy(*order)
    w_ch = Window.partitionBy(*[F.col("_key")[c] for c in part]).orderBy(F.col("_key")["_chunk"])
    d = d.withColumn("_rn", F.row_number().over(w_in))
    for c in carry:
        d = d.withColumn(f"_lag_{c}", F.lag(c).over(w_in))
    last = d.groupBy("_key").agg(F.max_by(F.struct(*carry), F.struct(*order)).alias("_last"))
    last = last.select("_key", F.lag("_last").over(w_ch).alias("_prev_last"))
    d = d.join(last, "_key")
    first = F.col("_rn") == 1
    prev = {c: F.when(first, F.col("_prev_last")[c]).otherwise(F.col(f"_lag_{c}")) for c in carry}
    has_prev = ~first | F.col("_prev_last").isNotNull()
    d = (d.withColumn("_new", (~has_prev) | F.coalesce(starts(prev, {c: F.col(c) for c in carry}), F.lit(False)))
          .drop("_rn", "_prev_last", *[f"_lag_{c}" for c in carry]))
    d = d.withColumn("_cin", F.sum(F.col("_new").cast("int")).over(w_in.rowsBetween(Window.unboundedPreceding, 0)))
    per = d.groupBy("_key").agg(F.sum(F.col("_new").cast("int")).alias("_k"))
    per = per.select("_key", F.coalesce(F.sum("_k").over(w_ch.rowsBetween(Window.unboundedPreceding, -1)),
                                       F.lit(0)).alias("_k0"))
    d = d.join(per, "_key")
    return d.withColumn(name, F.col("_k0") + F.col("_cin")).drop("_new", "_cin", "_k0", "_key")


def fold_steps(state: DataFrame, periods: Iterable, step: Callable[[DataFrame, object], DataFrame],
               cut_every: int = 1) -> DataFrame:
    """Apply a period step repeatedly (yesterday's table -> today's table).

    Every ``cut_every`` steps the state is checkpointed into the folder set
    by ``spark.checkpoint.dir``: the lineage stays one step long, a lost
    executor recomputes at most ``cut_every`` steps, and the plan does not
    grow with the number of periods.
    """
    for i, p in enumerate(periods, start=1):
        state = step(state, p)
        if cut_every and i % cut_every == 0:
            state = state.checkpoint(eager=True)
    return state

