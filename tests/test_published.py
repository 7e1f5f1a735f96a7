"""Write, audit, publish; guarded chains; the run parameter."""

import datetime as dt
import tempfile

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimforge.operators import activity as ac
from dimforge.operators import cumulation as cu
from dimforge.operators import patterns as pt
from dimforge.operators.published import AuditError, MissingPeriodError, PublishedTable, one_row_per
from dimforge.plans import activity as pa_, load_all, periods
from dimforge.session import scratch_path
from dimforge.sources.tables import TABLES


def table(spark, partition="day"):
    return PublishedTable(spark, scratch_path(spark, "published"), partition)


def rows(spark, *values):
    return spark.createDataFrame([(k, v, dt.date(2024, 1, d)) for k, v, d in values], "k string, v int, day date")


def test_failed_audit_leaves_the_old_version(spark):
    t = table(spark)
    t.load(rows(spark, ("a", 1, 1), ("b", 2, 1), ("c", 3, 2)), checks={"keys": one_row_per("k")})
    with pytest.raises(AuditError, match="keys"):
        t.load(rows(spark, ("a", 9, 1), ("a", 8, 1)), checks={"keys": one_row_per("k")})
    assert sorted((r.k, r.v) for r in t.read().collect()) == [("a", 1), ("b", 2), ("c", 3)]
    # a load that was stopped after its files were written is not seen either, and a rerun replaces its day only
    t.stage(rows(spark, ("z", 0, 1)))
    t.load(rows(spark, ("a", 7, 1)), [dt.date(2024, 1, 1), dt.date(2024, 1, 3)])
    assert sorted((r.k, r.v) for r in t.read().collect()) == [("a", 7), ("c", 3)]
    assert t.partitions() == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 0}
    assert t.read([dt.date(2024, 1, 3)]).count() == 0 and t.read().schema == rows(spark, ("a", 1, 1)).schema


def test_null_partition_is_published(spark):
    t = table(spark)
    t.load(spark.createDataFrame([("a", 1, None), ("b", 2, dt.date(2024, 1, 1))], "k string, v int, day date"))
    assert sorted(map(str, t.read([None]).collect())) == ["Row(k='a', v=1, day=None)"]


def jobs_run(spark, call):
    sc = spark.sparkContext
    sc.setJobGroup("guard", "guard")
    try:
        call()
    finally:
        found = list(sc.statusTracker().getJobIdsForGroup("guard"))
        sc.setLocalProperty("spark.jobGroup.id", None)
    return found


def test_guard_fires_without_a_job(spark):
    chain = table(spark, "current_season")
    snap = spark.createDataFrame([("p", 1998)], "player_id string, current_season int")
    chain.load(snap)
    assert jobs_run(spark, lambda: cu.cumulate_chain_guard(chain, 1999, first_period=1995)) == []
    with pytest.raises(MissingPeriodError):
        cu.cumulate_chain_guard(chain, 2000, first_period=1995)
    cu.cumulate_chain_guard(chain, 1995, first_period=1995)


def test_a_missed_day_is_refused(spark):
    """The four daily chains: 3 January on a chain that ends on 1 January."""
    e = spark.createDataFrame([(1, "h", "b", dt.datetime(2024, 1, 1, 5)), (2, "h", "b", dt.datetime(2024, 1, 1, 6)),
                               (1, "h", "b", dt.datetime(2024, 1, 3, 5))],
                              "user_id long, host string, browser_type string, event_time timestamp_ntz")

    def chain(prev):
        t = table(spark, "date")
        t.load(prev)
        return t

    def growth():
        g = pt.growth_accounting(e, "user_id", "event_time", "2024-01-01")
        return g.withColumn("dates_active", F.array("date"))

    steps = {
        "users": (lambda: ac.dates_active_backfill(e, "user_id", "event_time", "2024-01-01"),
                  lambda c, ds: ac.dates_active_step(c, e, "user_id", "event_time", ds)),
        "hosts": (lambda: ac.dates_active_backfill(e, "host", "event_time", "2024-01-01"),
                  lambda c, ds: ac.dates_active_step(c, e, "host", "event_time", ds)),
        "devices": (lambda: pa_.user_device_dates_backfill(e, "2024-01-01"), lambda c, ds: pa_.user_device_dates_step(c, e, ds)),
        "growth": (growth, lambda c, ds: pt.growth_accounting_step(c, e, "user_id", "event_time", ds)),
    }
    for name, (first, step) in steps.items():
        c = chain(first())
        with pytest.raises(MissingPeriodError, match="2024-01-02"):
            step(c, "2024-01-03")
        c.load(step(c, "2024-01-02"))
        c.load(step(c, "2024-01-03"))
        keys = "host" if name == "hosts" else "user_id"
        assert c.read([dt.date(2024, 1, 3)]).select(keys).distinct().count() == (1 if name == "hosts" else 2), name


@pytest.fixture(scope="module")
def later(tmp_path_factory):
    """The small tables with events on 2 February and orders of 2003."""
    out = str(tmp_path_factory.mktemp("later"))
    for t in TABLES:
        data = pq.read_table(f"{SF_SMALL}/{t}.parquet")
        if t in ("events", "orders"):
            time, shift = ("ts", dt.datetime(2024, 2, 2, 10)) if t == "events" else ("o_orderdate", dt.datetime(2003, 5, 5))
            more = data.slice(0, 6)
            column = pa.array([shift] * 6).cast(data.schema.field(time).type)
            data = pa.concat_tables([data, more.set_column(data.schema.names.index(time), data.schema.field(time), column)])
        pq.write_table(data, f"{out}/{t}.parquet")
    return out


def test_last_period_comes_from_the_data(spark, later):
    from tools.oracle_check import norm
    assert periods.day(spark, later) == "2024-02-02" and periods.month(spark, later) == "2024-02-01"
    assert periods.year(spark, later) == 2003 and periods.day(spark, SF_SMALL) == "2024-01-30"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{later}/{t}.parquet')")
    for key in ("dates_active_step", "datelist_int", "metric_array_step", "hit_array_step", "host_reduced_step", "dim_ever_flags",
                "growth_accounting", "fact_retention", "write_ds_partitioned", "cumulate_step", "cumulate_step_multi",
                "history_explode", "scd2_incremental", "scd2_incremental_inactive", "scd_asof_join", "load_merge_upsert"):
        fn, sql = load_all()[key]
        df = fn(spark, later)
        cols = sorted(df.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(map(str, map(norm, df.select(*cols).collect()))) == sorted(map(str, map(norm, want))), key
