"""Structured Streaming: file source + availableNow runs on one checkpoint, checked against the
batch twin; watermark closure, late rows, NULL hosts, session boundaries."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimforge.sources import tables as tb
from dimforge.streaming import jobs as st

SCHEMA = "event_time timestamp, host string, ip string"


def _run(spark, src, ckpt, sink):
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    agg = st.stream_tumble(stream, ["host"])

    def collect(batch, _id):
        sink.extend(tuple(r) for r in batch.collect())

    q = (agg.writeStream.outputMode("append").option("checkpointLocation", ckpt)
            .foreachBatch(collect).trigger(availableNow=True).start())
    q.awaitTermination()


def test_tumbling_watermark_late_rows(spark):
    src, ckpt = tempfile.mkdtemp(prefix="dimforge-src-"), tempfile.mkdtemp(prefix="dimforge-ck-")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    sink = []

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(src)

    add([(t0 + dt.timedelta(seconds=10), "a", "x"), (t0 + dt.timedelta(minutes=6), "a", "x"),
         (t0 + dt.timedelta(minutes=1), None, "x")])
    _run(spark, src, ckpt, sink)
    # 00:05:50 is late by 10 s (inside the 15 s watermark): counted; 00:02:00 is behind a closed window: dropped
    add([(t0 + dt.timedelta(minutes=5, seconds=50), "a", "x"), (t0 + dt.timedelta(minutes=2), "a", "x")])
    _run(spark, src, ckpt, sink)
    add([(t0 + dt.timedelta(minutes=30), "a", "x")])
    _run(spark, src, ckpt, sink)
    got = {(r[0], r[1]): r[2] for r in sink}
    assert got[(t0, "a")] == 1                                    # the 00:02:00 row never reached it
    assert got[(t0 + dt.timedelta(minutes=5), "a")] == 2
    assert got.get((t0, None), 0) == 0                            # NULL host is not counted
    assert (t0 + dt.timedelta(minutes=30), "a") not in got        # newest window still open


def test_stream_equals_batch_twin_on_closed_windows(spark):
    raw = st.to_raw_json(tb.web_events_of(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    parsed = st.stream_parse(raw)
    batch = st.stream_tumble(parsed, ["host"])
    last = batch.agg(F.max("event_hour")).collect()[0][0]
    src, ckpt = tempfile.mkdtemp(prefix="dimforge-src-"), tempfile.mkdtemp(prefix="dimforge-ck-")
    raw.write.mode("overwrite").parquet(src)
    stream = st.stream_parse(spark.readStream.schema("value string").parquet(src))
    sink = []

    def collect(b, _id):
        sink.extend(tuple(r) for r in b.collect())

    q = (st.stream_tumble(stream, ["host"]).writeStream.outputMode("append")
           .option("checkpointLocation", ckpt).foreachBatch(collect).trigger(availableNow=True).start())
    q.awaitTermination()
    want = {tuple(r) for r in batch.filter(F.col("event_hour") < F.lit(last)).collect()}
    got = {r for r in sink if r[0] < last}
    assert got == want and len(want) > 100


def test_session_gap_boundary(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [("ip1", "h", t0), ("ip1", "h", t0 + dt.timedelta(minutes=5)),                       # exactly 5 min: one
            ("ip2", "h", t0), ("ip2", "h", t0 + dt.timedelta(minutes=5, microseconds=1))]       # 5 min + 1 us: two
    df = spark.createDataFrame(rows, "ip string, host string, event_time timestamp_ntz")
    got = {r.ip: r.n for r in st.stream_session(df, ["ip", "host"]).groupBy("ip").agg(F.count("*").alias("n")).collect()}
    assert got == {"ip1": 1, "ip2": 2}


def test_sink_rerun_is_idempotent(spark):
    """A second run on the same checkpoint adds nothing; a replayed batch replaces itself."""
    s = tb.web_events_of(st.events_stream(spark, SF_SMALL)).select("event_id", "url")
    want = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    run = st.StreamRun(spark, "sink-test")
    for _ in range(2):
        run.run(s)
        assert spark.read.parquet(run.sink).count() == want
    batch = spark.read.parquet(run.sink).filter("_batch = 0").select("event_id", "url").cache()
    batch.count()
    run.write_batch(batch, 0)
    assert spark.read.parquet(run.sink).count() == want


def _minutes(spark, rows):
    t0 = dt.datetime(2024, 1, 1, 23, 50, 0)
    return spark.createDataFrame([(t0 + dt.timedelta(minutes=m), h) for m, h in rows], "event_time timestamp, host string")


def test_replay_counts_late_rows(spark):
    """Rows of a second delivery that lie behind the watermark are dropped and counted."""
    run = st.StreamRun(spark, "late")
    rows = _minutes(spark, [(i, "ab"[i % 2]) for i in range(60)])
    build = lambda s: st.stream_tumble(s, ["host"])
    st.replay(spark, "late", rows, build, run=run)
    assert run.dropped == 0
    late = _minutes(spark, [(1, "a"), (2, "b"), (3, "a"), (59, "b")])
    st.replay(spark, "late", late, build, slices=1, closing={}, run=run)
    assert run.dropped == 3 or run.dropped == 2      # per row, or per partial count of a window
    got = run.result(build(rows).schema)
    assert got.agg(F.sum("num_hits")).first()[0] == 61 and got.filter("host is null").count() == 0


def test_upsert_sink_survives_an_uncommitted_batch(spark):
    rows = _minutes(spark, [(i % 45, "abc"[i % 3]) for i in range(200)])

    def build(s):
        return st.stream_tumble(s, ["host"]).withColumn("day", F.to_date("event_hour"))

    def result(fail_at):
        run = st.StreamRun(spark, "upsert")
        sink = st.KeyedSink(spark, run.sink, ["event_hour", "host"], "day")
        calls = []

        def write(batch, batch_id):
            sink(batch, batch_id)
            calls.append(batch_id)
            if len(calls) == fail_at:
                raise RuntimeError("stopped after the write, before the commit")

        for part in st.time_slices(rows, "event_time", 3):
            run.arrive(part)
            try:
                run.run(build(run.stream(rows.schema)), "update", write)
            except Exception as e:  # noqa: BLE001 - the stop above, and then the restart
                assert "before the commit" in str(e)
                run.run(build(run.stream(rows.schema)), "update", write)
        return sorted(map(tuple, sink.table.read().collect())), calls, sink

    want, calls, _ = result(0)
    assert want == sorted(map(tuple, build(rows).collect())) and len(calls) >= 3
    for at in range(1, len(calls) + 1):
        got, again, sink = result(at)
        assert got == want and len(again) == len(calls) + 1 and len(set(again)) == len(calls)
    # both days of the table were published
    assert sorted(sink.table.partitions()) == ["2024-01-01", "2024-01-02"]


def test_stream_dedup_within_watermark(spark):
    src, ckpt = tempfile.mkdtemp(prefix="dimforge-src-"), tempfile.mkdtemp(prefix="dimforge-ck-")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    schema = "event_id bigint, event_time timestamp"
    spark.createDataFrame([(1, t0), (1, t0), (2, t0 + dt.timedelta(minutes=1))], schema).write.parquet(src + "/a")
    sink = []

    def collect(b, _id):
        sink.extend(tuple(r) for r in b.collect())

    def run(sub):
        s = spark.readStream.schema(schema).parquet(src + "/" + sub)
        q = (st.stream_dedup(s, ["event_id"], watermark="10 minutes").writeStream.outputMode("append")
               .option("checkpointLocation", ckpt + "/" + sub).foreachBatch(collect)
               .trigger(availableNow=True).start())
        q.awaitTermination()

    run("a")
    assert sorted(r[0] for r in sink) == [1, 2]


def test_tumble_by_host_and_referrer_on_a_stream(spark):
    src, ckpt = tempfile.mkdtemp(prefix="dimforge-src-"), tempfile.mkdtemp(prefix="dimforge-ck-")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    schema = "event_time timestamp, host string, referrer string"
    spark.createDataFrame([(t0, "h", "r1"), (t0 + dt.timedelta(minutes=1), "h", "r1"), (t0, "h", None),
                           (t0 + dt.timedelta(hours=1), "h", "r1")], schema).write.parquet(src + "/in")
    sink = []

    def collect(b, _id):
        sink.extend(tuple(r) for r in b.collect())

    s = spark.readStream.schema(schema).parquet(src + "/in")
    q = (st.stream_tumble(s, ["host", "referrer"]).writeStream.outputMode("append")
           .option("checkpointLocation", ckpt).foreachBatch(collect).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r[1], r[2]): r[3] for r in sink if r[0] == t0}
    assert got == {("h", "r1"): 2, ("h", None): 1}
