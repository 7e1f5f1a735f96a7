"""Step loads across months and gaps, duplicate keys, wide addresses, bucketed copies, plan shapes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimforge.functions.columns import ip_number, ip_of
from dimforge.operators import activity as ac
from dimforge.operators import common
from dimforge.operators import layout as lo
from dimforge.operators import loads as ld
from dimforge.session import checkpoint_root
from dimforge.streaming import jobs as st


@pytest.fixture(scope="module")
def visits(spark):
    days = ["2024-01-29", "2024-01-31", "2024-01-31", "2024-02-01", "2024-02-03"]
    rows = [(u, dt.datetime.fromisoformat(d)) for u in (1, 2) for d in days if not (u == 2 and d == "2024-01-31")]
    return spark.createDataFrame(rows, "user_id long, t timestamp_ntz")


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_hit_array_chain_equals_backfill_over_a_month_boundary(visits):
    state = ac.hit_array_backfill(visits, "user_id", "t", "2024-01-30")
    for ds in ("2024-01-31", "2024-02-01", "2024-02-03", "2024-02-03"):  # a missed day, then a rerun
        step = ac.hit_array_step(state, visits, "user_id", "t", ds)
        assert rows_of(step) == rows_of(ac.hit_array_backfill(visits, "user_id", "t", ds))
        state = state.unionByName(step) if ds != "2024-02-03" else state


def test_metric_array_after_a_missed_day_and_a_rerun(visits):
    empty = visits.sparkSession.createDataFrame([], "user_id long, month_start date, metric_name string, metric_array array<long>")
    state = empty
    for ds in ("2024-01-29", "2024-01-31", "2024-01-31"):
        state = ac.metric_array_step(state, visits, "user_id", "t", ds)
    got = {r.user_id: r.metric_array for r in state.collect()}
    assert len(got[1]) == len(got[2]) == 31 and got[1][28:] == [1, 0, 2] and got[2][28:] == [1, 0, 0]
    moved = ac.metric_array_step(state, visits, "user_id", "t", "2024-02-01")
    assert {tuple(r.metric_array) for r in moved.filter("month_start = '2024-02-01'").collect()} == {(1,)}


def test_loads_reduce_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (2, "y"), (3, "p"), (3, "q")], "k int, v string")
    assert sorted(ld.load_merge_upsert(target, source, "k").collect()) == [(1, "a"), (2, "y"), (3, "q")]
    assert sorted(ld.load_insert_absent(target, source, "k").collect()) == [(1, "a"), (2, "b"), (3, "q")]


def test_visitors_past_two_to_the_24_keep_their_own_address(spark):
    users = [5, 16_777_221, 4_294_967_301, None]
    got = spark.createDataFrame([(u,) for u in users], "u long").select("u", ip_of(F.col("u")).alias("ip"))
    got = got.withColumn("n", ip_number(F.col("ip"))).collect()
    assert [r.n for r in got] == users and len({r.ip for r in got}) == 4


def test_geo_enrich_passes_null_addresses(spark):
    e = spark.createDataFrame([("10.0.0.5",), (None,), ("10.0.9.9",)], "ip string")
    r = spark.createDataFrame([(0, 0, 9, "c", "s", "t")], "range_no long, ip_lo long, ip_hi long, country string, state string, city string")
    got = {x.ip: x.geodata for x in st.stream_geo_enrich(e, r).collect()}
    assert got[None] == got["10.0.9.9"] == "{}" and '"country":"c"' in got["10.0.0.5"]


def test_batch_sessions_leave_out_null_times(spark):
    df = spark.createDataFrame([("a", None), ("a", dt.datetime(2024, 1, 1))], "k string, event_time timestamp_ntz")
    assert st.stream_session(df, ["k"]).count() == 1


def test_bucketed_join_sees_a_changed_input(spark, tmp_path):
    from dimforge.plans.layout import q_join_bucketed
    def put(n):
        spark.range(n).selectExpr("id AS o_orderkey", "'p' AS o_orderpriority").write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
        spark.range(n).selectExpr("id AS l_orderkey", "1.0D AS l_quantity").write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    put(5)
    assert q_join_bucketed(spark, str(tmp_path)).count() == 5
    put(9)
    assert q_join_bucketed(spark, str(tmp_path)).count() == 9


def test_island_and_position_helpers_move_the_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(1000).selectExpr("id", "id % 3 AS k", "id div 10 AS day", "id % 7 = 0 AS f")
        for out in (common.sequence_positions(df, "k", "day", ["id"], "f"),
                    common.number_islands(df, ["k"], F.col("day"), ["id"], ["f"], lambda p, c: p["f"] != c["f"])):
            plan = out._jdf.queryExecution().executedPlan().toString()
            joins = [ln for ln in plan.splitlines() if "SortMergeJoin" in ln]
            # joined on the windows' own key: no null-safe form, whose hashing would move the rows again
            assert out.count() == 1000 and joins and all("[_key#" in ln and "coalesce" not in ln for ln in joins)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_sort_check_sees_a_layout_that_is_not_sorted(spark, tmp_path):
    spark.range(100).selectExpr("100 - id AS x").coalesce(1).write.parquet(f"{tmp_path}/t")
    assert lo.out_of_order(spark.read.parquet(f"{tmp_path}/t"), ["x"]).first() == (100, 99)


def test_no_private_scratch_folder_on_a_cluster():
    class Conf:
        def get(self, _key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())
