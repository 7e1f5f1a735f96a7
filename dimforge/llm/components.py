"""Connected components of a link table by alternating star contraction.

Large star: every node hands the neighbours above it to its smallest
neighbour. Small star: every node hands the neighbours below it to the
smallest of them. Both keep the components; together they end, after a number
of rounds that grows with the logarithm of the longest path, in one star per
component (Kiveris et al., "Connected Components in MapReduce and Beyond").
Each round is two aggregations with map-side combine and two equi-joins, the
links of a hub being split by the adaptive skew join; no round gathers a
component anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dimforge.llm.common import materialise, salted

SALTS = 16


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of a link table (one row to the driver)."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links(u long, v long)`` -> ``(node, root)`` for every linked node.

    ``root`` is the smallest node reachable; a root is its own root. Self
    links, repeated links and either direction are allowed; rows with a null
    end are ignored. Nodes without links do not appear.
    """
    cur = (links.filter("u <> v")
           .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    cur = materialise(cur, "links")
    mark = _mark(cur)
    while mark[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = materialise(low.select("u", F.col("m").alias("v")).unionByName(small).distinct(), "links")
        new = _mark(nxt)
        cur = nxt
        if new == mark:
            break
        mark = new
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def with_heads(nodes: DataFrame, label: DataFrame) -> DataFrame:
    """``nodes(node, first, ...)`` with ``head``, the smallest ``first`` of each
    node's component; ``label`` is the result of ``components``.

    Nodes without links are their own head. Heads are joined salted: a
    component of a third of all nodes is read by ``SALTS`` tasks, and as every
    component in ``label`` has two nodes at least, the salted heads are at most
    half of ``SALTS`` times the linked nodes. Spark sizes the salted heads like
    the heads, and nodes and labels by their files, in which they are several
    times smaller, so both joins are sort-merge joins at every size.
    """
    named = nodes.join(label.hint("merge"), "node", "left")
    linked = named.filter("root is not null")
    heads = linked.groupBy("root").agg(F.min("first").alias("head"))
    linked, heads = salted(linked, F.col("node"), heads, SALTS)
    linked = linked.join(heads.hint("merge"), ["root", "__salt"]).drop("root", "__salt")
    return linked.unionByName(named.filter("root is null").drop("root").withColumn("head", F.col("first")))
