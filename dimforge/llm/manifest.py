"""Merkle manifest of a dataset, with proofs by pointer jumping.

Every row is a leaf. Per group (language) the leaves ascend by id; ``FAN``
consecutive nodes, a *run*, are hashed into one node of the next level until
one is left, the group's subroot. The subroots are folded likewise into the
root. A leaf's proof is what its siblings hash to, level by level.

Ranks come from one range shuffle and the row counts of its partitions. A node
above the leaves holds a segment of the proof: its own siblings, and a pointer
to its parent. Each round joins this table with itself, appends the segment of
the node pointed to and moves the pointer there, so the distance doubles and
all nodes reach the root in a logarithmic number of rounds. The leaves of one
run share all but the first step, so a run is one row until the end, and
segments are held once for ``FAN`` leaves. Nodes near the root are pointed to
by many; they are joined salted, by the number of nodes that can point there.

Only counts (partitions, groups, levels) decide on the driver; rows move in
shuffles and through tables in the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from dimforge.llm.common import drop_written, materialise, salted

FAN = 8
MAX_SALTS = 512
TOP = -1
STEPS = "array<struct<before:string,after:string>>"


def leaf(*cols: Column) -> Column:
    """SHA-256 of the fields: ``-`` for null, else UTF-8 byte count, ``:``,
    value."""
    texts = [c.cast("string") for c in cols]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _part_size(nodes: Column) -> Column:
    return F.ceil(nodes / FAN).cast("long")


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``at`` (rank in the group from 0, by ``order``), ``size``
    (rows of the group) and ``grp`` (rank of the group, null first).

    One range shuffle sorts all rows; the rest is arithmetic on one count for
    each group in each partition. Ties are broken by the place in the input,
    so repeated rows are dealt over several partitions too.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in (group, *order)] + [F.col("spread").asc()]
    dealt = (rows.withColumn("spread", F.monotonically_increasing_id())
             .repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("spread")
             .select("*", F.spark_partition_id().alias("part"),
                     F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")))
    dealt = materialise(dealt, "ranked")
    within = Window.partitionBy(group)
    spans = dealt.groupBy("part", group).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    spans = (spans.withColumn("earlier", F.sum("rows").over(within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("size", F.sum("rows").over(within))
             .withColumn("begins", F.col("earlier").isNull().cast("long")))
    # One row per partition: how many groups begin in the partitions before it.
    begun = (spans.groupBy("part").agg(F.sum("begins").alias("n"))
             .withColumn("begun", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n"))
    rank = F.col("begun") + F.sum("begins").over(Window.partitionBy("part").orderBy("first")) - 1
    spans = (spans.join(begun, "part").withColumn("grp", F.when(F.col("begins") == 1, rank))
             .withColumn("grp", F.max("grp").over(within)))
    held = spans.select(F.col("part").alias("p"), F.col(group).alias("g"), "first", "size", "grp",
                        F.coalesce("earlier", F.lit(0)).alias("earlier"))
    return (dealt.join(held, (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
            .withColumn("at", F.col("earlier") + F.col("place") - F.col("first"))
            .drop("part", "place", "p", "g", "first", "earlier"))


def _hashed(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def _named(nodes: DataFrame) -> DataFrame:
    """Keys ``g, l, i`` of nodes given by ``grp, level, at`` and ``size``, the
    number of nodes on their level: a subroot is node ``grp`` on level 0 of the
    top tree."""
    sub = (F.col("grp") != TOP) & (F.col("size") == 1)
    return nodes.select("*", F.when(sub, TOP).otherwise(F.col("grp")).cast("long").alias("g"),
                        F.when(sub, 0).otherwise(F.col("level")).cast("int").alias("l"),
                        F.when(sub, F.col("grp")).otherwise(F.col("at")).cast("long").alias("i"))


def _folded(nodes: DataFrame) -> DataFrame:
    """The runs of ``nodes(grp, level, at, size, digest, rise)`` as nodes of the
    next level, with their ``kids``."""
    kid = F.struct((F.col("at") % FAN).alias("place"), "digest", "rise")
    return _named(nodes.groupBy("grp", (F.col("level") + 1).alias("level"), F.floor(F.col("at") / FAN).alias("run"))
                  .agg(F.sort_array(F.collect_list(kid)).alias("kids"), F.first("size").alias("size"))
                  .select("grp", "level", F.col("run").alias("at"), _part_size(F.col("size")).alias("size"), "kids",
                          _hashed(F.col("kids.digest")).alias("digest"),
                          (F.array_max("kids.rise") + 1).alias("rise")))


def _others(kids: str, place: Column) -> tuple[Column, Column]:
    """Digests of a run before and after a place, each as one text."""
    return tuple(F.array_join(F.transform(F.filter(kids, keep), lambda k: k["digest"]), "")
                 for keep in (lambda k: k["place"] < place, lambda k: k["place"] > place))


def _edges(runs: DataFrame, groups: int) -> DataFrame:
    """From each node below ``runs`` to its parent: the pointer (``ug, ul, ui``
    with ``root``, its digest), whether that is the root (``done``), the
    siblings as one step, and ``subroot`` if the step begins or ends there."""
    last = (F.col("size") == 1) & ((F.col("grp") == TOP) | F.lit(groups == 1))
    before, after = _others("kids", F.col("kid.place"))
    own = F.when((F.col("grp") == TOP) & (F.col("level") == 1), F.col("kid.digest"))
    return (runs.withColumn("kid", F.explode("kids"))
            .select(F.col("grp").alias("g"), (F.col("level") - 1).cast("int").alias("l"),
                    (F.col("at") * FAN + F.col("kid.place")).alias("i"), F.col("kid.rise").alias("rise"),
                    F.col("g").alias("ug"), F.col("l").alias("ul"), F.col("i").alias("ui"), F.col("digest").alias("root"),
                    last.alias("done"),
                    F.coalesce(own, F.when((F.col("grp") != TOP) & (F.col("size") == 1), F.col("digest"))).alias("subroot"),
                    F.array(F.struct(before.alias("before"), after.alias("after"))).alias("steps")))


def _jumped(edges: DataFrame, distance: int) -> DataFrame:
    """Every pointer, ``distance`` levels long or at the root, twice as long."""
    open_ = edges.filter(~F.col("done"))
    # Only what lies so far above some run can be pointed to.
    ahead = edges.filter(F.col("rise") >= distance).select(
        F.col("g").alias("ug"), F.col("l").alias("ul"), F.col("i").alias("ui"),
        *[F.col(c).alias(f"n_{c}") for c in ("ug", "ul", "ui", "root", "done", "subroot", "steps")])
    open_, ahead = salted(open_, F.struct("g", "l", "i"), ahead, min(FAN ** (distance - 1), MAX_SALTS))
    moved = open_.join(ahead, ["ug", "ul", "ui", "__salt"]).select(
        "g", "l", "i", "rise", *[F.col(f"n_{c}").alias(c) for c in ("ug", "ul", "ui", "root", "done")],
        F.coalesce("subroot", "n_subroot").alias("subroot"), F.concat("steps", "n_steps").alias("steps"))
    return edges.filter("done").unionByName(moved)


def _height(nodes: int) -> int:
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FAN), levels + 1
    return levels


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
             leaf_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             claim: Column | None = None) -> DataFrame:
    """``id, leaf, claim, subroot, root, steps`` for every row of ``docs``.

    ``steps`` is the proof: per level the siblings' digests before and after
    the node, from the leaf up (no step where a group has one leaf, or the
    dataset one group). ``claim`` is a leaf digest computed from other data, to
    be checked against the proof (the row's own leaf if not given).

    Nulls are values in a leaf; a null group is a group, before all others;
    null ids come first in their group. Equal ids are ordered by their leaves;
    repeated rows are leaves of their own, in places that give them the same
    set of proofs in any run. Empty and very long texts are hashed whole. Other
    columns are not read. An empty table gives an empty result.
    """
    own = leaf(*[F.col(c) for c in leaf_cols])
    rows = docs.select(F.col(id_col).alias("id"), F.col(group_col).alias("lang"), own.alias("leaf"),
                       (own if claim is None else claim).alias("claim"))
    rows = ranked(rows, "lang", ["id", "leaf"])
    member = F.struct((F.col("at") % FAN).alias("place"), "leaf", "id", "claim")
    runs = (rows.groupBy("grp", F.floor(F.col("at") / FAN).alias("run"))
            .agg(F.sort_array(F.collect_list(member)).alias("members"), F.first("size").alias("leaves")))
    runs = runs.select("grp", F.lit(1).alias("level"), F.col("run").alias("at"), _part_size(F.col("leaves")).alias("size"),
                       F.transform("members", lambda m: F.struct(m["place"].alias("place"), m["leaf"].alias("digest"),
                                                                 m["id"].alias("id"), m["claim"].alias("claim"))).alias("kids"),
                       (F.col("leaves") == 1).alias("lone"))
    runs = runs.withColumn("digest", F.when(F.col("lone"), F.col("kids")[0]["digest"]).otherwise(_hashed(F.col("kids.digest"))))
    runs = materialise(_named(runs.withColumn("rise", F.lit(0))), "runs")
    groups, widest = runs.agg(F.coalesce(F.max("grp") + 1, F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()

    level, written, edges, tops = runs, [], [], []
    for _ in range(_height(widest)):
        tops.append(level)
        level = materialise(_folded(level.filter("size > 1")), "level")
        written.append(level)
        edges.append(_edges(level, groups))
    tops = [t.filter("size = 1").select(F.lit(TOP).cast("long").alias("grp"), F.lit(0).alias("level"),
                                        F.col("grp").alias("at"), F.lit(groups).cast("long").alias("size"), "digest", "rise")
            for t in (*tops, level)]
    level = reduce(DataFrame.unionByName, tops)
    for _ in range(_height(groups)):
        level = materialise(_folded(level), "level")
        written.append(level)
        edges.append(_edges(level, groups))

    proven = runs.select("g", "l", "i", "kids", "lone", "digest")
    if edges:
        table, distance = materialise(reduce(DataFrame.unionByName, edges), "segments"), 1
        drop_written(*written)
        while distance < len(edges):
            longer = materialise(_jumped(table, distance), "segments")
            drop_written(table)
            table, distance = longer, 2 * distance
        proven = proven.join(table.select("g", "l", "i", "root", "subroot", "steps"), ["g", "l", "i"], "left")
    else:
        proven = proven.select("*", F.lit(None).cast("string").alias("root"), F.lit(None).cast("string").alias("subroot"),
                               F.lit(None).cast(STEPS).alias("steps"))
    before, after = _others("kids", F.col("kid.place"))
    first = F.when(F.col("lone"), F.array().cast(STEPS)).otherwise(
        F.array(F.struct(before.alias("before"), after.alias("after"))))
    return (proven.withColumn("kid", F.explode("kids"))
            .select(F.col("kid.id").alias(id_col), F.col("kid.digest").alias("leaf"), F.col("kid.claim").alias("claim"),
                    F.coalesce("subroot", "digest").alias("subroot"), F.coalesce("root", "digest").alias("root"),
                    F.concat(first, F.coalesce("steps", F.array().cast(STEPS))).alias("steps")))


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded_root(steps: Column, digest: Column) -> Column:
    """The root that a leaf digest and a proof lead to."""
    return F.aggregate(steps, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))
