"""Loads are rerun-safe; file sources; the typed enrich job gives one answer in its DataFrame and SQL forms."""

import tempfile

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from conftest import SF_SMALL
from dimforge.operators import layout as lo
from dimforge.operators import loads as ld
from dimforge.session import scratch_path
from dimforge.sources import files
from dimforge.sources import tables as tb


def test_partition_overwrite_rerun_is_idempotent(spark):
    df = tb.web_events(spark, SF_SMALL).withColumn("d", F.to_date("event_time")).select("event_id", "d")
    path = scratch_path(spark, "rerun")
    ld.load_partition_overwrite(df, path, ["d"])
    ld.load_partition_overwrite(df, path, ["d"])
    one_day = df.filter(F.col("d") == F.lit("2024-01-05").cast("date"))
    ld.load_partition_overwrite(one_day, path, ["d"])
    back = spark.read.parquet(path).select("event_id", F.col("d").cast("date").alias("d"))
    assertDataFrameEqual(back, df)


def test_merge_upsert_null_in_source_wins(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    got = ld.load_merge_upsert(target, source, "k")
    assertDataFrameEqual(got, spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string"))


def test_insert_absent_keeps_existing(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "z"), (2, "b")], "k int, v string")
    assertDataFrameEqual(ld.load_insert_absent(target, source, "k"),
                         spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))


def test_replace_table_never_overwrites_its_input(spark):
    first = ld.replace_table(spark, tb.read(spark, SF_SMALL, "nation"), "nation")
    second = ld.replace_table(spark, spark.read.parquet(first).withColumn("x", F.lit(1)), "nation")
    assert first != second
    assert spark.read.parquet(second).count() == spark.read.parquet(first).count() == 25


def test_csv_with_and_without_types(spark):
    path = files.write_csv(tb.read(spark, SF_SMALL, "nation"), tempfile.mkdtemp(prefix="dimforge-csv-") + "/n")
    untyped = files.read_csv(spark, path)
    assert dict(untyped.dtypes)["n_nationkey"] == "string"
    typed = files.read_csv(spark, path, schema="n_nationkey int, n_name string, n_regionkey int")
    assert dict(typed.dtypes)["n_nationkey"] == "int" and typed.count() == 25
    inferred = files.read_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["n_nationkey"] == "int"


def test_enrich_dataframe_and_sql_agree(spark):
    ev, dv = tb.web_events(spark, SF_SMALL), tb.web_devices(spark, SF_SMALL)
    assertDataFrameEqual(lo.enrich_typed(ev, dv), lo.enrich_typed_sql(spark, ev, dv))


def test_cached_reuse_feeds_both_reports(spark):
    out = {}
    lo.cached_reuse(tb.web_events(spark, SF_SMALL), tb.web_devices(spark, SF_SMALL),
                    lambda df: out.__setitem__("u", df.count()), lambda df: out.__setitem__("d", df.count()))
    assert out["u"] > 0 and out["d"] > 0


def test_ctas_then_insert_overwrite_one_partition(spark):
    import uuid
    name = f"daily_{uuid.uuid4().hex[:8]}"
    df = (tb.web_events(spark, SF_SMALL).withColumn("d", F.to_date("event_time"))
            .groupBy("url", "d").agg(F.count(F.lit(1)).alias("n")))
    ld.create_table_as(spark, df, name, ["d"])
    day = F.lit("2024-01-03").cast("date")
    ld.insert_overwrite(df.filter(F.col("d") == day).withColumn("n", F.lit(0).cast("bigint")), name)
    t = spark.table(name)
    assert t.filter(F.col("d") == day).agg(F.sum("n")).collect()[0][0] == 0
    assert t.filter(F.col("d") != day).count() == df.filter(F.col("d") != day).count()


def test_checked_broadcast_falls_back_above_the_bound(spark):
    nation = tb.read(spark, SF_SMALL, "nation")
    orders = tb.read(spark, SF_SMALL, "orders").join(tb.read(spark, SF_SMALL, "customer"),
                                                    F.col("o_custkey") == F.col("c_custkey"))
    small = orders.join(lo.checked_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString() or \
        "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    none = lo.checked_broadcast(nation, max_bytes=1)
    assert none is nation


def test_experiment_buckets_are_stable_and_balanced(spark):
    from dimforge.operators import experiments as ex
    users = spark.range(0, 20000).withColumnRenamed("id", "user_id")
    a = ex.experiment_assign(users, "user_id", "salt-a")
    b = ex.experiment_assign(users, "user_id", "salt-a")
    assert a.exceptAll(b).count() == 0
    share = a.filter(F.col("cell") == "treatment").count() / 20000
    assert 0.47 < share < 0.53
