"""Experiments and KPIs: stable assignment, exposure, readout, profit and growth metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.functions.columns import experiment_bucket

# fixed value: cost proxy per unit as a share of the part's retail price
COST_SHARE = 0.6


def experiment_assign(users: DataFrame, key: str, salt: str, split: int = 50) -> DataFrame:
    b = experiment_bucket(F.col(key), salt)
    return users.select(key, b.alias("bucket"),
                        F.when(b < split, F.lit("treatment")).otherwise(F.lit("control")).alias("cell"))


def experiment_exposure_log(events: DataFrame, key: str, ts: str, type_col: str, exposure: str,
                            outcome: str, within_hours: int | None = None) -> DataFrame:
    """First exposure per entity and the first outcome strictly after it (optionally within a window)."""
    e = events.filter(F.col(key).isNotNull())
    first = e.filter(F.col(type_col) == exposure).groupBy(key).agg(F.min(ts).alias("exposed_at"))
    outs = e.filter(F.col(type_col) == outcome).select(key, F.col(ts).alias("_o"))
    cond = F.col("_o") > F.col("exposed_at")
    if within_hours is not None:
        cond = cond & (F.col("_o") <= F.col("exposed_at") + F.make_dt_interval(hours=F.lit(within_hours)))
    after = (outs.join(first, key).filter(cond)
                 .groupBy(key).agg(F.min("_o").alias(f"{outcome}_at")))
    return first.join(after, key, "left")


def experiment_readout(assign: DataFrame, exposures: DataFrame, key: str, outcome_col: str) -> DataFrame:
    """Per cell users and conversions, rates, lift and the pooled two-proportion z score.

    A single global aggregation with conditional counts (partial-aggregated),
    so no join between the cells' rows is needed.
    """
    j = exposures.join(assign, key).withColumn("_conv", F.col(outcome_col).isNotNull())
    a = j.agg(F.count_if(F.col("cell") == "control").alias("n_control"),
              F.count_if((F.col("cell") == "control") & F.col("_conv")).alias("conv_control"),
              F.count_if(F.col("cell") == "treatment").alias("n_treatment"),
              F.count_if((F.col("cell") == "treatment") & F.col("_conv")).alias("conv_treatment"))
    pc = F.try_divide(F.col("conv_control"), F.col("n_control"))
    pt = F.try_divide(F.col("conv_treatment"), F.col("n_treatment"))
    p = F.try_divide(F.col("conv_control") + F.col("conv_treatment"), F.col("n_control") + F.col("n_treatment"))
    se = F.sqrt(p * (1 - p) * (F.try_divide(F.lit(1.0), F.col("n_control")) +
                               F.try_divide(F.lit(1.0), F.col("n_treatment"))))
    return a.select("*", F.round(pc, 6).alias("rate_control"), F.round(pt, 6).alias("rate_treatment"),
                    F.round(F.try_divide(pt - pc, pc), 6).alias("lift"),
                    F.round(F.when(se > 0, F.try_divide(pt - pc, se)), 6).alias("z_score"))


def line_profit(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Profit per line = net revenue minus ``COST_SHARE`` x retail price x quantity (a stated proxy)."""
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    j = lineitem.join(p, "l_partkey", "left")
    money = "decimal(18,2)"    # exact cents: sums do not depend on the order rows are added in
    net = F.col("l_extendedprice").cast(money) * (1 - F.col("l_discount").cast("decimal(4,2)"))
    cost = (F.coalesce(F.col("p_retailprice"), F.lit(0.0)).cast(money) * F.lit(COST_SHARE).cast("decimal(3,2)")
            * F.col("l_quantity").cast(money))
    return j.withColumn("profit", net - cost)


def kpi_unit_profit(lines: DataFrame, unit: Sequence[str]) -> DataFrame:
    return (lines.groupBy(*unit).agg(F.sum("l_quantity").alias("units"), F.sum("profit").alias("_p"))
                 .select(*unit, F.round("units", 2).alias("units"),
                         F.round("_p", 2).cast("double").alias("profit"),
                         # exact IEEE division of two exact values: no rounding tie to disagree on
                         F.try_divide(F.col("_p").cast("double"), F.col("units")).alias("unit_profit")))


def kpi_aggregate_profit(lines: DataFrame, ts: str) -> DataFrame:
    m = F.trunc(F.to_date(ts), "month").alias("month")
    return lines.groupBy(m).agg(F.round(F.sum("profit"), 2).cast("double").alias("total_profit"),
                                F.round(F.sum("l_quantity"), 2).alias("total_units"))


def kpi_daily_growth(events: DataFrame, key: str, ts: str) -> DataFrame:
    e = events.filter(F.col(key).isNotNull())
    active = e.groupBy(F.to_date(ts).alias("date")).agg(F.countDistinct(key).alias("active_users"))
    new = (e.groupBy(key).agg(F.min(F.to_date(ts)).alias("date"))
             .groupBy("date").agg(F.count(F.lit(1)).alias("new_users")))
    return active.join(new, "date", "left").fillna(0, ["new_users"])


def kpi_aggregate_growth(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("new_users").alias("total_new_users"),
                     F.sum("active_users").alias("total_active_user_days"),
                     F.round(F.avg("active_users"), 6).alias("avg_daily_active_users"))


def kpi_engagement(events: DataFrame, key: str, ts: str) -> DataFrame:
    e = events.filter(F.col(key).isNotNull())
    return (e.groupBy(F.to_date(ts).alias("date"))
             .agg(F.count(F.lit(1)).alias("events"), F.countDistinct(key).alias("active_users"))
             .withColumn("events_per_user", F.round(F.col("events") / F.col("active_users"), 6)))


def dash_filtered_facts(df: DataFrame, dims: Sequence[str], value: str, all_label: str = "(all)") -> DataFrame:
    """Flat cube for a filterable dashboard: every subset of ``dims`` with hits and value.

    Dims are made non-null (and text) before the cube so a rolled-up row is
    told apart from a real NULL by the label alone.
    """
    d = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in dims], value)
    d = d.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))  # Expand copies groups, not rows
    c = d.cube(*dims).agg(F.sum("_n").alias("hits"), F.round(F.sum("_v"), 2).alias("total_value"))
    return c.select(*[F.coalesce(F.col(x), F.lit(all_label)).alias(x) for x in dims], "hits", "total_value")
