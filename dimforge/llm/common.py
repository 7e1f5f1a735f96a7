"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import dimforge
from dimforge.session import scratch_path


def ship(spark: SparkSession | None = None) -> None:
    """Hand this package to the executors' Python workers, once per context,
    so that they import it wherever they run (and keep what its modules cache
    from one task to the next)."""
    context = (spark or SparkSession.active()).sparkContext
    if not getattr(context, "_dimforge_shipped", False):
        root = Path(dimforge.__file__).parent
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/dimforge", "zip", root.parent, root.name))
        context._dimforge_shipped = True


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor costs a re-read of shared files, and
    two readers see the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def drop_written(*tables: DataFrame) -> None:
    """Delete the files of tables that ``materialise`` wrote and nothing reads
    any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sampled(rows: DataFrame, group: str, spread: Column, n: int, groups: int) -> tuple[DataFrame, dict]:
    """About ``n`` rows (a quarter more) of each of the ``groups`` most frequent
    values of ``group``, and the number of rows of each.

    ``spread`` is a hash that decides alone which rows are taken, so nothing is
    shuffled but counts; the rows taken are bounded by ``n * groups``, and the
    caller cuts each group to ``n``.
    """
    most = rows.groupBy(group).count().orderBy(F.col("count").desc(), group).limit(groups).collect()
    counts = {r[group]: r["count"] for r in most}
    if not counts:
        return rows.filter("false"), counts
    share = F.create_map(*[F.lit(x) for k, c in counts.items() for x in (k, min(1.0, 1.25 * n / c))])
    place = F.shiftrightunsigned(spread, 11) / F.lit(float(1 << 53))
    return rows.filter(place < F.coalesce(F.element_at(share, F.col(group)), F.lit(0.0))), counts


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(*cols: Column) -> tuple[Column, Column]:
    """128 bits naming the content of ``cols``; nulls hash like any value.

    Every column is hashed with its null flag, so (null, 'a') and ('a', null)
    differ.
    """
    parts = [p for c in cols for p in (c.isNull(), c)]
    return F.xxhash64(F.lit(0), *parts), F.xxhash64(F.lit(1), *parts)


def salted(rows: DataFrame, spread: Column, table: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a column ``__salt``: each row of ``rows`` has
    one salt, each row of ``table`` stands once per salt, so a key that holds
    a third of ``rows`` is shared by up to ``salts`` tasks."""
    return (rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")),
            table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table that the caller holds as Python values, as one JSON
    constant in the plan: no Python worker and no RDD behind it."""
    import json

    text = F.lit(json.dumps(rows))
    return spark.range(1, numPartitions=1).select(F.inline(F.from_json(text, f"array<struct<{schema}>>")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
