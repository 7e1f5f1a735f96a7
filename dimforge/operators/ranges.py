"""Lookup of numbers in ranges of any width, as an equi-join.

Ranges are cut into aligned blocks of a few sizes (powers of ``2 ** BITS``); a
number probes one key per block size. Overlaps are resolved beforehand: the
number line is cut at every range end, and each segment takes the narrowest
range over it, so a number lies in exactly one block and a probe finds at most
one row. That holds on a stream too, where nothing could be aggregated after
the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from dimforge.operators.loads import replace_table

BITS = 4
CHUNK_BITS = 20
LEVELS = tuple(range(0, CHUNK_BITS + 1, BITS))
# block sizes that whole ranges are made of while they are ranked
SPAN_LEVELS = tuple(range(0, 41, BITS))


def _shift(c: Column, bits: int) -> Column:
    return F.shiftright(c, bits)


def _run(level: int, lo: Column, hi: Column) -> Column:
    """Blocks ``lo`` to ``hi`` of a level; none if ``hi`` is less."""
    some = F.transform(F.sequence(lo, hi), lambda k: F.struct(F.lit(level).alias("level"), k.alias("block")))
    return F.when(lo <= hi, some).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))


def blocks_of(lo: Column, hi: Column, levels: Sequence[int] = LEVELS) -> Column:
    """The aligned blocks that make up ``lo..hi``.

    On each level the blocks are those between the range's ends that no block
    of the next level covers.
    """
    at = {n: (_shift(lo + ((1 << n) - 1), n), _shift(hi + 1, n)) for n in levels}
    out = []
    for n in levels:
        a, b = at[n]
        if n == levels[-1]:
            out.append(_run(n, a, b - 1))
        else:
            up_a, up_b = (F.shiftleft(x, BITS) for x in at[n + BITS])
            inner = F.concat(_run(n, a, up_a - 1), _run(n, up_b, b - 1))
            out.append(F.when(up_a < up_b, inner).otherwise(_run(n, a, b - 1)))
    return F.concat(*out)


def probes_of(number: Column, levels: Sequence[int] = LEVELS) -> Column:
    """The block of each level that a number lies in."""
    return F.array(*[F.struct(F.lit(n).alias("level"), _shift(number, n).alias("block")) for n in levels])


@dataclass(frozen=True)
class RangeBlocks:
    """``table(level, block, values...)`` covering every number from 0 up to
    ``end``; ``values`` are null where no range is."""

    table: DataFrame
    end: int
    values: tuple[str, ...]


def range_blocks(ranges: DataFrame, lo: str, hi: str, values: Sequence[str], tie: str) -> RangeBlocks:
    """Blocks of ``ranges``; where they overlap the narrowest counts, of equal
    widths the first to begin, then the smallest ``tie``. Ranges with a null
    end, or that end before they begin, hold nothing; what lies below 0 is cut
    off. The table is written once, so a stream does not make it for each batch.

    Ranges are numbered by rank, and each block keeps the least number only:
    a segment meets one candidate per block size, however many ranges overlap.
    """
    spark = ranges.sparkSession
    r = (ranges.filter(F.col(lo).isNotNull() & (F.col(hi) >= F.greatest(F.col(lo), F.lit(0))))
               .select(F.greatest(F.col(lo), F.lit(0)).cast("bigint").alias("lo"), F.col(hi).cast("bigint").alias("hi"),
                       F.struct((F.col(hi) - F.col(lo)).alias("width"), F.col(lo).alias("from"), F.col(tie).alias("tie")).alias("rank"),
                       F.struct(*values).alias("v")))
    # written, as the numbers of another run may differ
    numbered = r.orderBy("rank").select("lo", "hi", "v", F.monotonically_increasing_id().alias("n"))
    ranked = spark.read.schema(numbered.schema).parquet(replace_table(spark, numbered, "range-ranks"))
    last, widest = ranked.agg(F.max("hi"), F.max(F.col("hi") - F.col("lo"))).first()
    chunks = 0 if last is None else (last >> CHUNK_BITS) + 1
    size = 1 << CHUNK_BITS
    # blocks wider than every range hold none
    levels = SPAN_LEVELS[:1] + tuple(n for n in SPAN_LEVELS[1:] if (1 << n) <= (widest or 0) + 1)
    best = (ranked.select("n", F.inline(blocks_of(F.col("lo"), F.col("hi"), levels)))
                  .groupBy("level", "block").agg(F.min("n").alias("n")))
    # segments between all ends, cut at the chunks
    ends = (ranked.select(F.explode(F.array(F.col("lo"), F.col("hi") + 1)).alias("s"))
             .unionByName(spark.range(chunks).select((F.col("id") * size).alias("s"))).distinct()
             .filter(F.col("s") < chunks * size))
    within = Window.partitionBy(_shift(F.col("s"), CHUNK_BITS)).orderBy("s")
    segments = ends.withColumn("e", F.coalesce(F.lead("s").over(within),
                                               (_shift(F.col("s"), CHUNK_BITS) + 1) * size) - 1)
    found = (segments.select("s", "e", F.explode(probes_of(F.col("s"), levels)).alias("_p")).select("s", "e", "_p.*")
                     .join(best, ["level", "block"], "left").groupBy("s", "e").agg(F.min("n").alias("n")))
    flat = found.join(ranked.select("n", "v"), "n", "left").select(F.col("v.*"), F.inline(blocks_of(F.col("s"), F.col("e"))))
    table = flat.select("level", "block", *values)
    return RangeBlocks(spark.read.schema(table.schema).parquet(replace_table(spark, table, "range-blocks")), chunks * size, tuple(values))


def range_lookup(rows: DataFrame, number: Column, blocks: RangeBlocks) -> DataFrame:
    """``rows`` with the values of the range that ``number`` lies in; each row
    once. Numbers that are null or outside all blocks have nulls: they probe a
    level that no block has, under a key of their own, so they share no task."""
    outside = number.isNull() | (number < 0) | (number >= blocks.end)
    nowhere = F.array(F.struct(F.lit(-1).alias("level"), F.xxhash64(*rows.columns).alias("block")))
    spread = rows.withColumn("_probe", F.explode(F.when(outside, nowhere).otherwise(probes_of(number.cast("bigint")))))
    held = blocks.table.select(F.col("level").alias("_l"), F.col("block").alias("_b"), F.lit(True).alias("_hit"),
                               *[F.col(v).alias(f"_v_{v}") for v in blocks.values])
    j = spread.join(held, (F.col("_probe.level") == F.col("_l")) & (F.col("_probe.block") == F.col("_b")), "left")
    j = j.filter(F.col("_hit").isNotNull() | (F.col("_probe.level") == -1))
    return j.select(*rows.columns, *[F.col(f"_v_{v}").alias(v) for v in blocks.values])
