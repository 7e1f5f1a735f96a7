"""Embedding near-duplicates in cells of spherical k-means.

Equal vectors are one row with a count. Centroids come from k-means on the
unit sphere over a bounded sample; every vector is assigned to its home cell
and visits every other cell that may be home to a vector it links with, as a
bound on angles proves: no link is lost, whatever the data and the centroids.
In a cell its own vectors are compared with all vectors that visit it, in
blocks, by matrix products in double precision. A block returns link counts and
a spanning forest of its links, never its pairs.

The bound spares comparisons where the data form clusters. Vectors spread
evenly over many dimensions are compared nearly all with all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dimforge.llm.common import materialise, ship
from dimforge.llm.components import components, with_heads

MIN_COSINE = 0.9
# Bound of the sample that the centroids are fitted on, rounds and cells.
SAMPLE = 20_000
ROUNDS = 8
MAX_CELLS = 8192
SEED = 7
BLOCK = 4096
STRIP = 512
# Similarities of vectors and centroids that are held at a time.
HELD = 1 << 21
# Far above the rounding errors of the bound.
ROUNDING = 1e-7


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centroids of unit rows ``x``; an empty cell starts again at
    the row that fits its own cell worst."""
    rng = np.random.default_rng(SEED)
    c = x[np.sort(rng.choice(len(x), k, replace=False))]
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        empty = np.flatnonzero(norm < 1e-9)
        if len(empty):
            worst = np.argsort(np.einsum("nd,nd->n", x, c[near]), kind="stable")[:len(empty)]
            total[empty], norm[empty] = x[worst], 1.0
        c = total / norm[:, None]
    return c


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    # Scaled first, so that squares neither overflow nor vanish.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _visits(x: np.ndarray, centroids: np.ndarray, min_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cells of unit rows ``x`` and, as a matrix, the cells each is sent
    to, its home among them.

    The vectors nearer to b than to a lie beyond the plane through the origin
    with the normal a - b. A row at home in a is asin(x (a - b) / |a - b|) away
    from it, so no vector beyond it is within acos(min_cosine) if that is less.
    Of two cells one is sent the other's rows: the lower one if the sum of
    their numbers is even, else the higher.
    """
    sim = x @ centroids.T
    home = sim.argmax(1)
    square = np.einsum("kd,kd->k", centroids, centroids)
    gap = np.sqrt(np.maximum(square[home, None] + square - 2 * (centroids[home] @ centroids.T), 0))
    sine = math.sqrt(max(0.0, 1 - min_cosine * min_cosine)) if min_cosine > 0 else math.inf
    cell, own = np.arange(len(centroids)), home[:, None]
    near = np.take_along_axis(sim, own, 1) - sim <= sine * (gap + ROUNDING) + ROUNDING
    return home, near & ((cell < own) == ((cell + own) % 2 == 0)) | (cell == own)


def _assign(nodes: DataFrame, kind: str, centroids: np.ndarray, min_cosine: float) -> DataFrame:
    """``node, n, raw, home, cells``: the cells a vector is sent to."""
    step = max(1, HELD // len(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            homes, cells = [], []
            for at in range(0, batch.num_rows, step):
                home, sent = _visits(_unit(batch.column("raw").slice(at, step).to_pylist(), kind), centroids, min_cosine)
                homes += home.tolist()
                cells += [np.flatnonzero(row).tolist() for row in sent]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "n", "raw")), pa.array(homes, pa.int32()),
                 pa.array(cells, pa.list_(pa.int32()))], names=["node", "n", "raw", "home", "cells"])

    return nodes.mapInArrow(assign, "node long, n long, raw binary, home int, cells array<int>")


def _packed(nodes: DataFrame, kind: str) -> DataFrame:
    """``node, n, raw``: vectors as the bytes of their components."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.asarray(v, kind).tobytes() for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), pa.array(raw, pa.binary())],
                                             names=["node", "n", "raw"])

    return nodes.select("node", "n", "v").mapInArrow(pack, "node long, n long, raw binary")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(node, root)`` with the same components as the links a - b."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[:len(a)], ends[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    out = root != np.arange(len(names))
    return names[out], names[root[out]]


def compare(cell: int, part: pd.DataFrame, kind: str, min_cosine: float) -> pd.DataFrame:
    """Links of two blocks of a cell: rows at home there against its visitors.

    A pair at home in different cells meets in one of them; a pair at home here
    meets both ways round. Result rows: (node, null, copies linked),
    (node, root, 0).
    """
    home, part = part[part["side"] == 0], part[part["side"] == 1]
    if home.empty or part.empty:
        return pd.DataFrame({"u": [], "v": [], "links": []}).astype("Int64")
    x, y = _unit(home["raw"].tolist(), kind), _unit(part["raw"].tolist(), kind)
    a, b = home["node"].to_numpy(), part["node"].to_numpy()
    na, nb, hb = home["n"].to_numpy(), part["n"].to_numpy(), part["home"].to_numpy()
    links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    trees: list[tuple[np.ndarray, np.ndarray]] = []
    for at in range(0, len(a), STRIP):
        i, j = np.nonzero(x[at:at + STRIP] @ y.T >= min_cosine)
        i += at
        good = a[i] != b[j]
        i, j = i[good], j[good]
        away = hb[j] != cell
        np.add.at(links_a, i, nb[j])
        np.add.at(links_b, j[away], na[i[away]])
        if len(i):
            trees.append(_forest(a[i], b[j]))
    out = [(a[links_a > 0], None, links_a[links_a > 0]), (b[links_b > 0], None, links_b[links_b > 0])]
    if trees:
        u, v = _forest(np.concatenate([t[0] for t in trees]), np.concatenate([t[1] for t in trees]))
        out.append((u, v, np.zeros(len(u), np.int64)))
    return pd.concat([pd.DataFrame({"u": u, "v": pd.array([pd.NA] * len(u) if v is None else v, "Int64"), "links": n})
                      for u, v, n in out], ignore_index=True)


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         min_cosine: float = MIN_COSINE, cells: int | None = None) -> DataFrame:
    """``id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors that are null, empty, zero or hold a null or a non-finite component
    link with nothing and are their own component, kept. Rows with equal
    vectors link with each other, rows with null ids too, which come after all
    others as representatives. Vectors of different lengths are compared within
    their length only. Other columns are not read; an empty table gives an
    empty result.
    """
    ship(vectors.sparkSession)
    v = F.col(vector_col)
    wide = F.transform(v, lambda e: e.cast("double"))
    good = F.coalesce((F.size(v) > 0) & ~F.exists(wide, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
                      & F.exists(wide, lambda e: e != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"), good.alias("good"),
                          F.xxhash64(F.lit(0), v).alias("k1"), F.xxhash64(F.lit(1), v).alias("k2"))
    first = F.min(F.struct(F.col("id").isNull(), "id")).alias("first")
    nodes = materialise(rows.filter("good").groupBy("k1", "k2").agg(F.count("*").alias("n"), first, F.first("v").alias("v"))
                        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = None
    for (length,) in nodes.select(F.size("v")).distinct().collect():  # the few lengths that vectors have
        one = _linked(nodes.filter(F.size("v") == length), min_cosine, cells)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = materialise(found, "vector-links")
    counts = found.filter("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    label = components(found.filter("v is not null").select("u", "v"))
    named = with_heads(nodes.select("node", "n", "first", "k1", "k2").join(counts, "node", "left"), label)
    named = named.select("k1", "k2", "n", "links", F.col("head.id").alias("head"))
    return (rows.withColumn("k1", F.when(F.col("good"), F.col("k1"))).drop("v").join(named, ["k1", "k2"], "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("good"), F.coalesce("links", F.lit(0)) + F.col("n") - 1).otherwise(0).cast("long").alias("n_links"),
                    F.when(F.col("good"), F.col("head")).otherwise(F.col("id")).alias("component_id"))
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id"))))


def _linked(nodes: DataFrame, min_cosine: float, cells: int | None) -> DataFrame:
    """Result rows of ``compare`` for distinct vectors of one length."""
    kind = "<f4" if nodes.schema["v"].dataType.elementType.typeName() == "float" else "<f8"
    total = nodes.count()
    # More cells than blocks would only send every vector to more of them where
    # the bound spares little, as inside a dense cluster.
    k = max(1, min(cells or math.ceil(total / BLOCK), MAX_CELLS, total))
    # Collected as bytes: a list of numbers takes several times the room on the driver.
    sample = _packed(nodes.orderBy("k1", "k2").limit(max(SAMPLE, k)), kind).select("raw").collect()
    centroids = spherical_kmeans(_unit([bytes(r["raw"]) for r in sample], kind), k)
    placed = materialise(_assign(_packed(nodes, kind), kind, centroids, min_cosine), "cells")
    seen = placed.withColumn("cell", F.explode("cells"))
    # At most k rows: into how many blocks a cell's own rows and visitors go.
    sizes = seen.groupBy("cell").agg(
        F.ceil(F.greatest(F.sum((F.col("home") == F.col("cell")).cast("long")), F.lit(1)) / BLOCK).alias("own"),
        F.ceil(F.count("*") / BLOCK).alias("all"))
    seen = seen.join(F.broadcast(sizes), "cell")

    def side(rows: DataFrame, number: int, i: Column, j: Column) -> DataFrame:
        return (rows.withColumn("i", i).withColumn("j", j)
                .select("cell", "i", "j", F.lit(number).alias("side"), "node", "n", "raw", "home"))

    at_home = seen.filter(F.col("home") == F.col("cell"))
    pairs = side(at_home, 0, F.pmod(F.xxhash64("node"), "own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1))
                 ).unionByName(side(seen, 1, F.explode(F.sequence(F.lit(0).cast("long"), F.col("own") - 1)),
                                    F.pmod(F.xxhash64("node"), "all")))

    def links(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return compare(int(key[0]), part, kind, min_cosine)

    return pairs.groupBy("cell", "i", "j").applyInPandas(links, "u long, v long, links long")


def near_duplicates(*args, **kwargs) -> DataFrame:
    """One representative per group: the rows of ``embedding_components`` that
    are kept."""
    return embedding_components(*args, **kwargs).filter("kept")
