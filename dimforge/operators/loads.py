"""Idempotent loads: partition overwrite, merge/upsert, insert-if-absent, bounded ranges, completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.operators.common import cols
from dimforge.session import scratch_path


def load_partition_overwrite(df: DataFrame, path: str, part_cols: Sequence[str]) -> str:
    """DELETE period + INSERT as one rerun-safe write: only the partitions present in ``df``
    are replaced (dynamic partition overwrite), the others are left alone."""
    # clustered first (AQE splits a large partition), or every task would write into every folder
    (df.hint("rebalance", *part_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*part_cols).parquet(path))
    return path


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The greatest row of each key, values compared in column order; combined map-side, and
    hashed on the keys as the join that follows needs it."""
    vals = [c for c in df.columns if c not in keys]
    if not vals:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max(F.struct(*vals)).alias("_v")).select(*keys, *[f"_v.{c}" for c in vals])


def load_merge_upsert(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """MERGE: matched keys take the source row, unmatched rows of either side are kept.

    A source-present flag (not ``coalesce`` of values) decides, so a NULL in
    the source still overwrites the target value. One full outer join on the keys;
    of source rows with one key the greatest (values compared in column order) counts.
    """
    keys = cols(keys)
    vals = [c for c in target.columns if c not in keys]
    s = one_per_key(source.select(*keys, *vals), keys).select(*keys, *vals).withColumn("_in_src", F.lit(True)).alias("s")
    t = target.select(*keys, *vals).alias("t")
    j = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    src = F.coalesce(F.col("s._in_src"), F.lit(False))
    return j.select(*[F.when(src, F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in keys],
                    *[F.when(src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in vals])


def load_insert_absent(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: source rows whose key is already present are ignored,
    and of those with one new key the greatest is inserted."""
    keys = cols(keys)
    new = one_per_key(source.select(*target.columns), keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new)


def load_bounded_range(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Both ends fixed (``lo < col <= hi``): a rerun never picks up later data."""
    c = F.col(col)
    return df.filter((c > F.lit(lo).cast(df.schema[col].dataType)) & (c <= F.lit(hi).cast(df.schema[col].dataType)))


def partition_completeness(actual: DataFrame, expected: DataFrame, part: str, expected_col: str) -> DataFrame:
    """Rows per partition against a control count: a partition that exists is not yet complete."""
    got = actual.groupBy(part).agg(F.count(F.lit(1)).alias("actual_rows"))
    j = expected.select(part, F.col(expected_col).alias("expected_rows")).join(got, part, "full_outer")
    return j.select(part, F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
                    F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
                    (F.coalesce("expected_rows", F.lit(0)) == F.coalesce("actual_rows", F.lit(0))).alias("is_complete"))


def replace_table(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Write a new version of a table to a fresh path and return it.

    Overwriting a path the same plan reads from fails midway and loses the
    data, so a rebuilt table always lands in a new folder and callers switch
    their pointer after the write has succeeded.
    """
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return path


def create_table_as(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
    """CREATE TABLE ... AS SELECT into the session catalog, stored under the shared folder."""
    (df.write.mode("errorifexists").partitionBy(*partition_by)
       .option("path", scratch_path(spark, name)).saveAsTable(name))
    return name


def insert_overwrite(df: DataFrame, table: str) -> None:
    """INSERT OVERWRITE into an existing partitioned table: only the partitions present in
    ``df`` are replaced. Columns are matched by name (``insertInto`` itself is positional and
    a partitioned table keeps its partition columns last)."""
    spark = df.sparkSession
    aligned = df.select(*spark.table(table).columns)
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        aligned.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)

