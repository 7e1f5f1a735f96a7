"""Event-time streaming: parse, enrich, tumbling windows, sessions, dedupe, sinks.

Every transformation is a plain DataFrame function, so the same code runs on
a ``readStream`` frame (with the watermark enforced) and on a static frame
(``withWatermark`` is a no-op there). ``replay`` runs it as a stream over a
stored table that arrives in slices of event time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.functions.columns import ip_number, ip_of
from dimforge.operators.common import number_islands
from dimforge.operators.loads import load_merge_upsert
from dimforge.operators.published import PublishedTable
from dimforge.operators.ranges import RangeBlocks, range_blocks, range_lookup
from dimforge.session import scratch_path
from dimforge.sources import tables as tb

# fixed values of the original stream jobs
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
WATERMARK = "15 seconds"
TUMBLE = "5 minutes"
SESSION_GAP = "5 minutes"

RAW_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("referrer", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("headers", T.StringType()),
    T.StructField("event_time", T.StringType()),
])


def to_raw_json(web: DataFrame) -> DataFrame:
    """Web events as the JSON ``value`` strings a message bus would carry."""
    return web.select(F.to_json(F.struct(
        "url", "referrer", F.lit("Mozilla/5.0").alias("user_agent"), "host", ip_of(F.col("user_id")).alias("ip"),
        F.date_format("event_time", EVENT_TIME_PATTERN).alias("event_time"))).alias("value"))


def stream_parse(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text -> typed columns; event time parsed with the fixed pattern (TIMESTAMP, for watermarks)."""
    p = raw.select(F.from_json(F.col(value), RAW_SCHEMA).alias("j")).select("j.*")
    return p.withColumn("event_time", F.to_timestamp("event_time", EVENT_TIME_PATTERN))


GEO = ("country", "state", "city")


def geo_blocks(ranges: DataFrame) -> RangeBlocks:
    """The range dimension (``ip_lo, ip_hi, range_no``, GEO), ready for look-ups."""
    return range_blocks(ranges, "ip_lo", "ip_hi", GEO, "range_no")


def stream_geo_enrich(events: DataFrame, ranges: DataFrame | RangeBlocks, ip: str = "ip") -> DataFrame:
    """ip -> JSON {country, state, city}; '{}' when no range holds the address.

    The per-row HTTP lookup of the original job is re-aimed as a range
    dimension; ranges have any width and may overlap (the narrowest counts).
    The lookup is an equi-join on blocks, also between a stream and the table.
    """
    blocks = ranges if isinstance(ranges, RangeBlocks) else geo_blocks(ranges)
    names = events.columns
    plain = events.select(F.struct(*names).alias("_e"), ip_number(F.col(ip)).alias("_n"))
    j = range_lookup(plain, F.col("_n"), blocks)
    geo = F.when(F.col("country").isNotNull(), F.to_json(F.struct(*GEO))).otherwise(F.lit("{}"))
    return j.select("_e.*", geo.alias("geodata"))


def stream_process(raw: DataFrame, ranges: DataFrame | RangeBlocks) -> DataFrame:
    """Parse + enrich, projected to the processed-events sink schema."""
    p = stream_parse(raw)
    return stream_geo_enrich(p, ranges).select("ip", "event_time", "referrer", "host", "url", "geodata")


def _event_ts(df: DataFrame, ts: str) -> DataFrame:
    # watermarks need TIMESTAMP (not TIMESTAMP_NTZ); with the session in UTC the wall clock is unchanged
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def stream_tumble(events: DataFrame, keys: Sequence[str], ts: str = "event_time", size: str = TUMBLE,
                  watermark: str = WATERMARK, count_col: str = "host") -> DataFrame:
    """Tumbling-window count of ``count_col`` (NULLs not counted) per key, window start as ``event_hour``."""
    e = _event_ts(events, ts).withWatermark(ts, watermark)
    g = e.groupBy(F.window(ts, size).alias("w"), *keys).agg(F.count(count_col).alias("num_hits"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("event_hour"), *keys, "num_hits")


def stream_session(events: DataFrame, keys: Sequence[str], ts: str = "event_time", gap: str = SESSION_GAP,
                   watermark: str = WATERMARK, tie: str | None = None) -> DataFrame:
    """Sessions per key: a new one starts when the gap to the previous event exceeds ``gap``.

    A stream uses ``session_window`` (state store, closed by the watermark).
    A static frame is sessionised without funnelling a key into one task:
    ``number_islands`` numbers sessions from (key, hour) chunks, so one
    visitor with a third of all events is still spread over many tasks.
    Both give the same sessions: events exactly ``gap`` apart share one.
    """
    e = _event_ts(events, ts)
    if e.isStreaming:
        g = (e.withWatermark(ts, watermark)
              .groupBy(F.session_window(ts, gap).alias("s"), *keys).agg(F.count(F.lit(1)).alias("num_events")))
        return g.select(*keys, F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                        F.col("s.end").cast("timestamp_ntz").alias("session_end"), "num_events")
    e = e.filter(F.col(ts).isNotNull())  # as the stream does: no event time, no session
    gap_i = F.expr(f"INTERVAL {gap}")
    order = [ts] + ([tie] if tie else [])
    s = number_islands(e.select(*keys, *order), list(keys), F.date_trunc("hour", ts), order, [ts],
                       lambda prev, cur: cur[ts] > prev[ts] + gap_i, name="_session")
    g = s.groupBy(*keys, "_session").agg(F.min(ts).alias("_start"), F.max(ts).alias("_last"),
                                         F.count(F.lit(1)).alias("num_events"))
    return g.select(*keys, F.col("_start").cast("timestamp_ntz").alias("session_start"),
                    (F.col("_last") + gap_i).cast("timestamp_ntz").alias("session_end"), "num_events")


def session_avg_events(sessions: DataFrame, by: Sequence[str]) -> DataFrame:
    return sessions.groupBy(*by).agg(F.count(F.lit(1)).alias("n_sessions"),
                                     F.round(F.avg("num_events"), 6).alias("avg_events"))


def stream_dedup(events: DataFrame, keys: Sequence[str], ts: str = "event_time",
                 watermark: str = "1 hour") -> DataFrame:
    """Drop re-deliveries of a key seen within the watermark delay (bounded state).

    On a static frame (the batch twin) every copy is inside the delay, so the
    same result is a plain ``dropDuplicates`` (the within-watermark form is
    streaming-only).
    """
    e = _event_ts(events, ts)
    if not e.isStreaming:
        return e.dropDuplicates(list(keys))
    return e.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def events_stream(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """A driver table read as a file stream (stands in for the message-bus topic)."""
    schema = tb.read(spark, sf_dir, table).schema
    return (spark.readStream.format("parquet").schema(schema)
                 .option("pathGlobFilter", f"{table}.parquet").option("maxFilesPerTrigger", 1)
                 .load(sf_dir))


@dataclass
class StreamRun:
    """One streaming query's lasting places: its source folder, checkpoint and
    sink. Every ``run`` continues where the last one stopped."""

    spark: SparkSession
    name: str
    root: str = ""
    dropped: int = 0      # rows behind the watermark, of all runs

    def __post_init__(self) -> None:
        self.root = self.root or scratch_path(self.spark, self.name)

    @property
    def source(self) -> str:
        return f"{self.root}/source"

    @property
    def sink(self) -> str:
        return f"{self.root}/sink"

    def arrive(self, rows: DataFrame) -> None:
        """New files of the topic."""
        rows.write.mode("append").parquet(self.source)

    def stream(self, schema: T.StructType) -> DataFrame:
        return self.spark.readStream.schema(schema).parquet(self.source)

    def run(self, df: DataFrame, mode: str = "append", write: Callable[[DataFrame, int], None] | None = None) -> None:
        """Process what has arrived (``availableNow``), then stop."""
        q = (df.writeStream.outputMode(mode).option("checkpointLocation", f"{self.root}/checkpoint")
               .foreachBatch(write or self.write_batch).trigger(availableNow=True).start())
        q.awaitTermination()
        for p in q.recentProgress:
            self.dropped += sum(s["numRowsDroppedByWatermark"] for s in json.loads(p.json)["stateOperators"])

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Append sink: each micro-batch is a partition, so a replayed batch
        overwrites itself instead of appending twice."""
        (batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(self.sink))

    def result(self, schema: T.StructType) -> DataFrame:
        kinds = T.StructType([*schema.fields, T.StructField("_batch", T.IntegerType())])
        return self.spark.read.schema(kinds).parquet(self.sink).drop("_batch")


def time_slices(rows: DataFrame, ts: str, n: int) -> list[DataFrame]:
    """``rows`` cut at ``n - 1`` equally spaced event times; rows without one
    come first. Each slice is read through a pushed range filter."""
    low, high = rows.agg(F.min(ts), F.max(ts)).first()
    if n == 1 or low is None or low == high:
        return [rows]
    cuts = [low + (high - low) * i / n for i in range(1, n)]
    at = [F.lit(c).cast(rows.schema[ts].dataType) for c in cuts]
    within = [F.col(ts).isNull() | (F.col(ts) < at[0]),
              *[(F.col(ts) >= a) & (F.col(ts) < b) for a, b in zip(at, at[1:])], F.col(ts) >= at[-1]]
    return [rows.filter(w) for w in within]


def replay(spark: SparkSession, name: str, rows: DataFrame, build: Callable[[DataFrame], DataFrame], ts: str = "event_time",
           slices: int = 3, closing: dict | None = None, mode: str = "append",
           write: Callable[[DataFrame, int], None] | None = None, run: StreamRun | None = None) -> StreamRun:
    """Run ``build`` as a stream over a stored table that arrives in slices of
    event time, one run per slice on one checkpoint, with state and watermark.

    With ``closing`` (values of some columns) the last slice ends with a row a
    year after the last event, which moves the watermark past all windows; the
    window of that row itself stays open.
    """
    run = run or StreamRun(spark, name)
    parts = time_slices(rows, ts, slices)
    if closing is not None:
        last = rows.agg(F.max(ts).alias("last")).filter("last IS NOT NULL")
        end = last.select(*[((F.col("last") + F.expr("INTERVAL 1 YEAR")) if c == ts else F.lit(closing.get(c)))
                            .cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
        parts[-1] = parts[-1].unionByName(end)
    for part in parts:
        run.arrive(part)
        run.run(build(run.stream(rows.schema)), mode, write)
    return run


class KeyedSink:
    """``foreachBatch`` sink for update mode: the newest row of each key.

    The rows a batch brings are merged into the partitions they fall into, and
    these are published at once together with the batch id. A batch that was
    published, but not yet committed to the query's checkpoint, comes again
    after a restart; its id is in the manifest, so nothing is written. Only
    partitions with new rows are rewritten.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], partition: str):
        self.table, self.keys = PublishedTable(spark, root, partition), list(keys)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        now = self.table.manifest()
        if now["token"] is not None and now["token"] >= batch_id:
            # its rows are there; it is still run, as that is what commits the state store
            batch.write.format("noop").mode("overwrite").save()
            return
        batch = batch.persist()      # read for its partitions and for the merge
        try:
            touched = [r[0] for r in batch.select(self.table.partition).distinct().collect()]
            if not touched:
                return
            rows = batch if now["schema"] is None else load_merge_upsert(self.table.read(touched), batch, self.keys)
            self.table.load(rows.select(*batch.columns), touched, token=batch_id)
        finally:
            batch.unpersist()


def run_available_now(df: DataFrame, spark: SparkSession, name: str, mode: str = "append", root: str = "") -> str:
    """Run a streaming frame to completion (``availableNow``) into a parquet
    table; a named ``root`` continues an earlier run. Returns the table path."""
    run = StreamRun(spark, name, root)
    run.run(df, mode)
    return run.sink
