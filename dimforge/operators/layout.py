"""Physical layout and join strategy: enrich joins, cached reuse, sorts, partitioned / bucketed writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimforge.operators.common import number_islands
from dimforge.session import scratch_path

# fixed value: default referrer of the typed enrich job (spelling kept as in the original job)
MISSING_REFERRER = "unknow"
BROADCAST_MAX_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer size estimate of a plan (None if unavailable)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - estimate is advisory
        return None


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the optimizer's size estimate is under ``max_bytes``.

    Above the bound (or without an estimate) the frame is returned as is, so
    the join falls back to a shuffle join (and AQE may still broadcast it
    at runtime from real sizes).
    """
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def enrich_left_join(events: DataFrame, devices: DataFrame, renames: dict[str, str]) -> DataFrame:
    return events.join(devices, "device_id", "left").withColumnsRenamed(renames)


def enrich_typed(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Null-checked events INNER JOIN devices, default referrer, upper-cased browser."""
    e = events.filter(F.col("user_id").isNotNull() & F.col("device_id").isNotNull()).alias("e")
    d = devices.alias("d")
    return (e.join(d, F.col("e.device_id") == F.col("d.device_id"), "inner")
             .select(F.col("e.user_id"), F.col("d.device_id"), F.upper(F.col("d.browser_type")).alias("browser_type"),
                     F.col("d.os_type"), F.col("d.device_type"),
                     F.coalesce(F.col("e.referrer"), F.lit(MISSING_REFERRER)).alias("referrer"),
                     F.col("e.host"), F.col("e.url"), F.col("e.event_time")))


def enrich_typed_sql(spark: SparkSession, events: DataFrame, devices: DataFrame) -> DataFrame:
    """The same join through a temp view and SQL text (third form of the original job)."""
    return spark.sql(f"""
        WITH known AS (SELECT * FROM {{ev}} WHERE isnotnull(user_id) AND isnotnull(device_id))
        SELECT user_id, device_id, ucase(browser_type) AS browser_type, os_type, device_type,
               nvl(referrer, '{MISSING_REFERRER}') AS referrer, host, url, event_time
        FROM known INNER JOIN {{dev}} USING (device_id)""", ev=events, dev=devices)


def events_aggregated(events: DataFrame) -> DataFrame:
    """Per (user, device): event count and sorted distinct hosts (hosts per pair are few)."""
    return (events.filter(F.col("user_id").isNotNull())
                  .groupBy("user_id", "device_id")
                  .agg(F.count(F.lit(1)).alias("event_counts"),
                       F.array_sort(F.collect_set("host")).alias("host_array")))


def cached_reuse(events: DataFrame, devices: DataFrame, write_users, write_devices) -> None:
    """Build the (user, device) aggregate once, persist it, feed both reports, then release it.

    ``persist`` keeps the reused aggregate (memory, spilling to disk) so the
    second report does not rescan and re-shuffle the events; it is released
    as soon as both writers have run.
    """
    from pyspark import StorageLevel
    agg = events_aggregated(events).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_users(users_and_devices(agg))
        write_devices(devices_on_events(agg, devices))
    finally:
        agg.unpersist()


def users_and_devices(agg: DataFrame) -> DataFrame:
    """Per user, from the cached aggregate only: max hits on one device, and device count."""
    return agg.groupBy("user_id").agg(F.max("event_counts").alias("max_event_counts"),
                                      F.count(F.lit(1)).alias("n_devices"),
                                      F.sum("event_counts").alias("total_events"))


def devices_on_events(agg: DataFrame, devices: DataFrame) -> DataFrame:
    """Users per device (+ type) as normalised rows, never one unbounded list per device."""
    return (agg.join(devices.select("device_id", "device_type"), "device_id")
               .select("device_id", "device_type", "user_id", "event_counts"))


def layout_global_sort(df: DataFrame, n: int, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Hash-repartition then a total order: a second (range) exchange."""
    return df.repartition(n, *part).orderBy(*order)


def layout_local_sort(df: DataFrame, n: int, part: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Hash-repartition then sort inside each partition: one exchange, good run lengths per file."""
    return df.repartition(n, *part).sortWithinPartitions(*order)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    w.parquet(path)
    return path


def out_of_order(stored: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of a stored table, and those that sort before their predecessor in the same file."""
    w = Window.partitionBy("_f").orderBy("_i")
    r = stored.select(F.struct(*order).alias("_k"), F.col("_metadata.file_path").alias("_f"),
                      F.col("_metadata.row_index").alias("_i"))
    back = F.coalesce(F.col("_k") < F.lag("_k").over(w), F.lit(False))
    return r.select(back.cast("bigint").alias("_b")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                          F.coalesce(F.sum("_b"), F.lit(0)).alias("n_out_of_order"))


def layout_size_report(spark: SparkSession, variants: dict[str, DataFrame]) -> DataFrame:
    """Write each variant to a fresh path and report file count and bytes from ``_metadata``."""
    out = None
    for name, df in variants.items():
        p = write_parquet(df, scratch_path(spark, f"layout-{name}"))
        files = (spark.read.parquet(p).select(F.col("_metadata.file_path").alias("f"),
                                              F.col("_metadata.file_size").alias("s")).distinct())
        r = files.agg(F.count(F.lit(1)).alias("n_files"), F.sum("s").alias("total_bytes")) \
                 .withColumn("layout", F.lit(name))
        out = r if out is None else out.unionByName(r)
    return out


def layout_size_check(spark: SparkSession, variants: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Write each variant to a fresh path; per layout its rows and key groups,
    whether each key group lies in one file, and whether the layout takes no
    more bytes than the first one."""
    held = None
    for name, df in variants.items():
        rows = spark.read.parquet(write_parquet(df, scratch_path(spark, f"layout-{name}"))).select(
            *keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        one = rows.groupBy(*keys, "file").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"))
        one = one.withColumn("layout", F.lit(name))
        held = one if held is None else held.unionByName(one)
    groups = (held.groupBy("layout", *keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("files"))
                  .groupBy("layout").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_groups"),
                                         F.max("files").alias("files")))
    sizes = (held.groupBy("layout", "file").agg(F.first("size").alias("size"))
                 .groupBy("layout").agg(F.sum("size").alias("size")))
    # one row per layout: few enough to stand in one list
    first = F.filter("all", lambda x: x["layout"] == next(iter(variants)))[0]["size"]
    report = groups.join(sizes, "layout").groupBy().agg(
        F.collect_list(F.struct("layout", "n_rows", "n_groups", "files", "size")).alias("all"))
    return (report.select(F.explode("all").alias("x"), first.alias("first_size"))
                  .select("x.layout", "x.n_rows", "x.n_groups", (F.col("x.files") == 1).alias("group_in_one_file"),
                          (F.col("x.size") <= F.col("first_size")).alias("not_larger")))


def rle_runs(df: DataFrame, part: Sequence[str], order: Sequence[str], col: str, chunk: Column) -> DataFrame:
    """Run-length encode ``col`` inside each partition in ``order``: (value, run start, run length).

    ``chunk`` is a coarse column monotone in the order (e.g. the hour); runs
    are numbered by ``number_islands`` (a new run wherever the value differs
    from the previous row), so no window covers a whole partition and a hot
    partition is still split by chunk.
    """
    runs = number_islands(df.select(*part, *order, col), part, chunk, order, [col],
                          lambda prev, cur: ~prev[col].eqNullSafe(cur[col]), name="_run")
    return (runs.groupBy(*part, "_run", col)
                .agg(F.min(order[0]).alias("run_start"), F.count(F.lit(1)).alias("run_length"))
                .drop("_run"))


def write_bucketed(spark: SparkSession, df: DataFrame, n: int, key: str, name: str,
                   partition_by: Sequence[str] = ()) -> str:
    """``bucketBy(n, key).sortBy(key)`` as an external table under the shared folder, its files
    dealt by ``partition_by`` first: a join on the key reads whole buckets of the partitions it needs."""
    if partition_by:      # a task holds one bucket, so each partition has one file per bucket
        df = df.repartition(n, key)
    table = f"{name}_{scratch_path(spark, 't').rsplit('-', 1)[-1]}"
    (df.write.mode("overwrite").partitionBy(*partition_by).bucketBy(n, key).sortBy(key)
       .option("path", scratch_path(spark, table)).saveAsTable(table))
    return table
