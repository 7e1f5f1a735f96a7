"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``VNODES`` points of a ring of 64-bit hashes; a row belongs
to the next point clockwise of its own hash. No shard takes more than its
bound; what overflows a full shard continues clockwise to the next shard with
room. The bounds differ by one row at most and add up to all rows, so counts
are balanced exactly, and only the overflow leaves its home shard.

Spark counts the rows of each arc (the number of arcs is a parameter); the
walk round the ring needs those counts only and yields, for each arc, how many
of its rows go to which shard. Rows then find their shard and slot by their
rank within the arc. All work on rows is DataFrame operations.
"""

from __future__ import annotations

from collections import deque
from hashlib import blake2b

from pyspark.sql import Column, DataFrame, Window, functions as F

from dimforge.llm.common import literal_rows

VNODES = 128
# The ring is looked up through a grid on the top bits of the hash.
GRID_BITS = 12


def _point(shard: int, replica: int) -> int:
    return int.from_bytes(blake2b(f"{shard}/{replica}".encode(), digest_size=8).digest(), "big")


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(unsigned position, shard) of all virtual nodes, clockwise."""
    return sorted((_point(s, r), s) for s in range(shards) for r in range(vnodes))


def bounds(total: int, wanted: list[int]) -> list[int]:
    """Rows each shard takes: equal but for the remainder, which goes to the
    shards most wanted."""
    base, extra = divmod(total, len(wanted))
    out = [base] * len(wanted)
    for s in sorted(range(len(wanted)), key=lambda s: (-wanted[s], s))[:extra]:
        out[s] += 1
    return out


def walk(owners: list[int], counts: list[int], shards: int) -> list[tuple[int, int, int]]:
    """Flows ``(arc, shard, rows)``, in the order an arc's rows are dealt.

    Each arc first fills its own shard as far as the bound goes, then what is
    left moves clockwise, first come first served, into shards with room.
    """
    wanted = [0] * shards
    for s, n in zip(owners, counts):
        wanted[s] += n
    room = bounds(sum(counts), wanted)
    flows, over = [], []
    for arc, (s, n) in enumerate(zip(owners, counts)):
        take = min(n, room[s])
        room[s] -= take
        over.append(n - take)
        if take:
            flows.append((arc, s, take))
    moving: deque[list[int]] = deque()
    for lap in range(2):
        for arc, s in enumerate(owners):
            while moving and room[s]:
                first = moving[0]
                take = min(first[1], room[s])
                room[s] -= take
                first[1] -= take
                flows.append((first[0], s, take))
                if not first[1]:
                    moving.popleft()
            if lap == 0 and over[arc]:
                moving.append([arc, over[arc]])
    assert not moving, "after two laps every shard has been passed"
    return flows


def _grid(points: list[tuple[int, int]]) -> list[dict]:
    """For each cell of the grid: the first arc it touches and the points in
    it, as signed longs with the sign bit flipped (which keeps their order)."""
    out, arc = [], 0
    width = 1 << (64 - GRID_BITS)
    for cell in range(1 << GRID_BITS):
        inside = []
        first = arc
        while arc < len(points) and points[arc][0] < (cell + 1) * width:
            inside.append(points[arc][0] - (1 << 63))
            arc += 1
        out.append({"cell": cell, "first": first, "points": inside})
    return out


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16


def shard(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
          vnodes: int = VNODES) -> DataFrame:
    """``id, size, text_crc32, shard, home_shard, slot`` for every row of ``docs``.

    ``slot`` numbers a shard's rows from 0 without gaps; counts of shards
    differ by one at most. A row's hash is taken from its id and its text's
    checksum and size, so rows with null or equal ids spread by their texts;
    rows equal in all of these are interchangeable and dealt by rank. A null
    text has size 16 and the checksum of no bytes. Other columns are not read;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    points = ring(shards, vnodes)
    owners = [s for _, s in points]
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id"), _size(text).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"))
    rows = rows.withColumn("h", F.xxhash64(F.col("id").isNull(), "id", "crc", "size"))
    # A cell's points and the rows of one arc: sizes fixed by the parameters.
    grid = literal_rows(spark, _grid(points), "cell: long, first: long, points: array<bigint>")
    placed = (rows.withColumn("cell", F.shiftrightunsigned("h", 64 - GRID_BITS))
              .join(F.broadcast(grid), "cell")
              .withColumn("arc", F.pmod(F.expr(
                  "first + size(filter(points, p -> p < (h ^ cast(-9223372036854775808 as bigint))))"),
                  F.lit(len(points))))
              .select("id", "size", "crc", "h", "arc"))
    counts = [0] * len(points)
    for r in placed.groupBy("arc").count().collect():  # at most shards * vnodes rows
        counts[r["arc"]] = r["count"]
    flows = walk(owners, counts, shards)
    before = [0] * len(points)
    filled = [0] * shards
    deals: dict[int, list[dict]] = {}
    for arc, s, n in flows:
        deals.setdefault(arc, []).append({"until": before[arc] + n, "shard": s, "shift": filled[s] - before[arc]})
        before[arc] += n
        filled[s] += n
    table = literal_rows(spark, [{"arc": a, "home": owners[a], "deals": d} for a, d in deals.items()],
                         "arc: long, home: int, deals: array<struct<until: bigint, shard: int, shift: bigint>>")
    rank = F.row_number().over(Window.partitionBy("arc").orderBy("h", "id", "crc", "size")) - 1
    ranked = placed.withColumn("rank", rank).join(F.broadcast(table), "arc")
    deal = F.expr("filter(deals, d -> rank < d.until)[0]")
    return (ranked.withColumn("deal", deal)
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                    F.col("deal.shard").alias("shard"), F.col("home").alias("home_shard"),
                    (F.col("rank") + F.col("deal.shift")).alias("slot")))
