"""Vector code compression: product codebooks trained by member-resident Lloyd.

Vectors of integers are cut into equal parts; each part position has a codebook
of a few entries. A part is a row that lives with its owner: the table of
parts is bucketed by (position, entry, salt), where the entry is the one the
part belongs to and the salt splits an entry that many parts share.

A round assigns every part where it lies. Parts that keep their entry are
written by the task that read them, into the same bucket; only parts that
change entry go through a shuffle, to their new owner's bucket. Owners then
sum their resident members without any exchange, and the new codebook is made
of one row of sums for each (position, entry). Codebooks are the only values on
the driver and in the tasks' closures: ``ENTRIES`` times the vector length.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from dimforge.llm.common import drop_written, materialise, salted, ship
from dimforge.session import scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
SALTS = 16
# Components as integers stay below this, so that all sums of squares are exact.
LIMIT = 1 << 25
ROWS_AT_ONCE = 8192


def whole(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component; null for a vector that is null
    or holds a null or a non-finite component."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    good = vector.isNotNull() & ~F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ints = F.transform(wide, lambda x: F.when(F.abs(x) < LIMIT / scale, F.floor(F.lit(float(scale)) * x).cast("int"))
                       .otherwise(F.raise_error(F.lit(f"a component is {LIMIT // scale} or more")).cast("int")))
    return F.when(good, ints)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance for each row of ``x``; ties go to the lower
    index."""
    apart = (book * book).sum(1) - 2 * (x @ book.T)
    entry = apart.argmin(1)
    return entry, apart[np.arange(len(x)), entry] + (x * x).sum(1)


def _assigned(parts: DataFrame, books: np.ndarray) -> DataFrame:
    """``parts`` with ``entry`` set to the nearest one and ``moved`` if that is
    not ``owner``."""
    schema = T.StructType([*[parts.schema[c] for c in parts.columns if c not in ("entry", "moved")],
                           T.StructField("entry", T.IntegerType()), T.StructField("moved", T.BooleanType())])
    names = [c for c in parts.columns if c not in ("entry", "moved")]
    values = [c for c in names if c.startswith("c")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position = batch.column("position").to_numpy()
            x = np.stack([batch.column(c).to_numpy() for c in values], 1).astype(np.int64) if values else np.zeros((len(position), 0), np.int64)
            entry = np.zeros(len(position), np.int32)
            for p in range(len(books)):
                at = np.flatnonzero(position == p)
                for some in np.split(at, range(ROWS_AT_ONCE, len(at), ROWS_AT_ONCE)):
                    entry[some] = nearest(x[some], books[p])[0]
            moved = entry != batch.column("owner").to_numpy()
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(entry), pa.array(moved)],
                                             names=[*names, "entry", "moved"])

    return parts.mapInArrow(run, schema)


class Members:
    """The bucketed table of parts between two rounds: ``position, owner, salt,
    entry, c0, c1, ...`` under ``moved=false``, where owner and entry are the
    same, and those on the way to their owner under ``moved=true``."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name, self.path = f"members_{uuid.uuid4().hex[:12]}", scratch_path(spark, "members")

    def _add(self, rows: DataFrame) -> None:
        (rows.write.mode("append").format("parquet").option("path", self.path).partitionBy("moved")
         .bucketBy(self.buckets, "position", "owner", "salt").saveAsTable(self.name))

    def send(self, away: DataFrame) -> DataFrame:
        """Move parts to the buckets of their entries; all residents."""
        there = away.withColumn("owner", F.col("entry")).withColumn("moved", F.lit(False))
        self._add(there.repartition(self.buckets, "position", "owner", "salt"))
        return self.spark.table(self.name).filter("not moved")

    def settle(self, assigned: DataFrame) -> DataFrame:
        """Write assigned parts where they are, then send those that moved."""
        self._add(assigned)
        return self.send(self.spark.read.schema(assigned.schema).parquet(self.path).filter("moved"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _updated(residents: DataFrame, books: np.ndarray) -> np.ndarray:
    """New codebooks: owners sum their members in place, the salts of an entry
    are then added up."""
    values = [c for c in residents.columns if c.startswith("c")]
    owned = residents.groupBy("position", "owner", "salt").agg(
        F.count("*").alias("n"), *[F.sum(F.col(c).cast("long")).alias(c) for c in values])
    out = books.copy()
    for r in owned.groupBy("position", "owner").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in values]).collect():
        out[r["position"], r["owner"]] = [r[c] // r["n"] for c in values]
    return out


def train(vectors: DataFrame, books: np.ndarray, rounds: int = ROUNDS, salts: int = SALTS) -> np.ndarray:
    """Codebooks (positions, entries, part length) after ``rounds`` rounds of
    Lloyd over all of ``vectors(row long, v array<int>)``.

    A round that changes no entry ends the training: all others would be alike.
    """
    spark = vectors.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    positions, _, length = books.shape
    cut = [F.struct(F.lit(p).alias("position"), *[F.col("v")[p * length + j].alias(f"c{j}") for j in range(length)])
           for p in range(positions)]
    parts = (vectors.select(F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int").alias("salt"), F.explode(F.array(*cut)).alias("p"))
             .select("p.position", F.lit(-1).alias("owner"), "salt", *[F.col(f"p.c{j}").alias(f"c{j}") for j in range(length)]))
    before = None
    for _ in range(rounds):
        here = Members(spark, buckets)
        assigned = _assigned(parts, books)
        residents = here.send(assigned) if before is None else here.settle(assigned)
        if before is not None:
            before.drop()
        before, parts, old = here, residents, books
        books = _updated(residents, books)
        if (books == old).all():
            break
    if before is not None:
        before.drop()
    return books


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vectors(..., v array<int>)`` with ``code`` (two hex digits for each
    part) and ``error`` (squared distances to the entries) in place of ``v``."""
    names = [c for c in vectors.columns if c != "v"]
    schema = T.StructType([*[vectors.schema[c] for c in names], T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])
    positions, _, length = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                x = some.column("v").flatten().to_numpy().astype(np.int64).reshape(some.num_rows, positions, length)
                found = [nearest(x[:, p], books[p]) for p in range(positions)]
                entries = np.stack([e for e, _ in found], 1).astype(np.uint8)
                error = sum(d for _, d in found)
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in names], pa.array([r.tobytes().hex() for r in entries], pa.string()),
                     pa.array(error, pa.int64())], names=[*names, "code", "error"])

    return vectors.mapInArrow(run, schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, salts: int = SALTS) -> tuple[DataFrame, np.ndarray]:
    """``id, code, error, label_error`` for every kept row, and the codebooks.

    Vectors that are null or hold a null or a non-finite component are dropped;
    components become ``floor(SCALE * x)``. The codebooks start as the parts of
    the rows with the smallest ids (equal ids by their vectors, null ids last);
    with fewer rows than ``entries`` they have as many. Repeated rows are
    members of their own. ``label_error`` adds the errors of equal labels,
    nulls being one label. Other columns are not read. An empty table gives an
    empty result and empty codebooks; empty vectors have codes of zeros and no
    error. Vectors must have one length, a multiple of ``parts``, and
    components below ``LIMIT / SCALE`` in size.
    """
    spark = vectors.sparkSession
    ship(spark)
    kept = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole(F.col(vector_col)).alias("v"))
    kept = materialise(kept.filter("v is not null").withColumn("row", F.monotonically_increasing_id()), "whole-vectors")
    low, high = kept.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if low != high or (low or 0) % parts:
        raise ValueError(f"vectors of {low} to {high} components cannot be cut into {parts} equal parts")
    seeds = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    length = (low or 0) // parts
    books = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), parts, length).transpose(1, 0, 2).copy()
    if length:
        books = train(kept.select("row", "v"), books, rounds, salts)
    found = materialise(encode(kept.select("id", "label", "row", "v"), books), "codes")
    drop_written(kept)
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    # A label may hold a third of all rows; there are at most SALTS copies of
    # each label's total.
    rows, totals = salted(found, F.col("row"), totals.withColumnRenamed("label", "of"), SALTS)
    out = (rows.join(totals, F.col("label").eqNullSafe(F.col("of")) & (rows["__salt"] == totals["__salt"]))
           .select(F.col("id").alias(id_col), "code", "error", "label_error"))
    return out, books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
