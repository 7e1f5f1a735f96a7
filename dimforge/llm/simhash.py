"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into segments, each with a radius. Two
fingerprints at most 4 bits apart are within the radius of some segment there,
if the radii and the number of segments less one add up to 4: with three
segments, more than 1, 1 and 0 bits apart would be 2 + 2 + 1 bits; with two,
more than 2 and 1 would be 3 + 2. So every fingerprint enters one table per
segment under its segment value, asks each table for the small Hamming ball
around its own value, and every match is verified on all 64 bits.

Both splits find the same pairs. The one with the lower expected cost for the
number of distinct fingerprints is taken: three narrow segments ask for few
values, two wide ones keep buckets small beyond tens of millions.

Balls are enumerated upward only (values above the own one): of two different
values exactly one is the lower, so a segment fetches each pair once.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from dimforge.llm.common import free_names, materialise, row_key, ship
from dimforge.llm.components import components, with_heads

SHINGLE_WORDS = 4
MAX_BITS = 4
# (first bit, bits, radius) of each segment; radii and segments less one sum to
# MAX_BITS, see above.
Segments = tuple[tuple[int, int, int], ...]
SPLITS: tuple[Segments, ...] = (((0, 21, 1), (21, 21, 1), (42, 22, 0)), ((0, 32, 2), (32, 32, 1)))
# Buckets with more distinct fingerprints than this are linked through a
# leader first; it changes the plan for them, never the result.
HEAVY_BUCKET = 64
BIT_CHUNK = 1 << 16


def shingle_hashes(text: str, n: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``n`` words, repeats included.

    A-Z are lower-cased, words are runs without the six ASCII white space
    characters; fewer than ``n`` words make one shingle, no word none.
    """
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= n:
        return np.array([xxh64_intdigest(joined, 42)], np.uint64)
    ends = np.fromiter(map(len, words), np.int64, len(words))
    np.cumsum(ends, out=ends)
    ends += np.arange(len(words))
    starts = [0, *(ends[:-n] + 1).tolist()]
    return np.array([xxh64_intdigest(joined[a:b], 42)
                     for a, b in zip(starts, ends[n - 1:].tolist())], np.uint64)


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash; a bit is set if over half the hashes set it."""
    h = shingle_hashes(text or "", n)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), BIT_CHUNK):
        part = h[i:i + BIT_CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long, whole texts in Arrow batches."""
    ship()

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, n) for t in texts], np.uint64).view(np.int64))

    return simhash(text)


def _masks(bits: int, radius: int) -> list[int]:
    """Every change of 1 to ``radius`` of ``bits`` bits."""
    return [sum(1 << i for i in c) for r in range(1, radius + 1) for c in combinations(range(bits), r)]


def segments_for(fingerprints: int) -> Segments:
    """The split with the fewest values asked for and rows expected in their
    buckets."""
    def cost(split: Segments) -> float:
        return sum((1 + len(_masks(bits, radius))) * (1 + fingerprints / (1 << bits)) for _, bits, radius in split)

    return min(SPLITS, key=cost)


def _segment(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1))


def _tables(fps: DataFrame, segments: Segments) -> DataFrame:
    """(key, fp): each fingerprint under its value in each segment."""
    keys = F.array(*[_segment(F.col("fp"), first, bits) + F.lit(k << 32) for k, (first, bits, _) in enumerate(segments)])
    return fps.select(F.explode(keys).alias("key"), "fp")


def _probes(fps: DataFrame, segments: Segments) -> DataFrame:
    """(key, fp, own): the upward Hamming ball of each segment; ``own`` marks
    the centre, the fingerprint's own value."""
    balls = []
    for k, (first, bits, radius) in enumerate(segments):
        value, base = _segment(F.col("fp"), first, bits), F.lit(k << 32)
        balls.append(F.array(F.struct((value + base).alias("key"), F.lit(True).alias("own"))))
        if radius:
            masks = F.array(*[F.lit(m).cast("long") for m in _masks(bits, radius)])
            up = F.filter(F.transform(masks, lambda m: value.bitwiseXOR(m)), lambda x: x > value)
            balls.append(F.transform(up, lambda x: F.struct((x + base).alias("key"), F.lit(False).alias("own"))))
    return fps.select("fp", F.explode(F.concat(*balls)).alias("e")).select("fp", "e.key", "e.own")


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def _links(fps: DataFrame, max_bits: int, segments: Segments = SPLITS[0]) -> DataFrame:
    """Links ``(u, v)`` with the same components as all pairs of distinct
    fingerprints at most ``max_bits`` apart. Every such pair is fetched and
    verified, but for pairs in heavy buckets whose ends are known to be in
    one component already."""
    tab, ask = _tables(fps, segments), _probes(fps, segments)
    heavy = materialise(tab.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("lead"))
                        .filter(F.col("n") > HEAVY_BUCKET).select("key", "lead"), "heavy")

    def match(table: DataFrame, probe: DataFrame, extra: Column | None = None) -> DataFrame:
        t = table.select("key", F.col("fp").alias("u"), *[F.col("c").alias("cu") for _ in [1] if "c" in table.columns])
        p = probe.withColumnRenamed("fp", "v").withColumnRenamed("c", "cv")
        on = (t.key == p.key) & _near("u", "v", max_bits) & (~F.col("own") | F.expr("v < u"))
        # Spark sizes an exploded table like the one it comes from, and so would
        # broadcast the probes, some 25 a fingerprint, of millions of them.
        return t.join(p.hint("merge"), on if extra is None else on & extra)

    if heavy.isEmpty():
        return match(tab, ask).select("u", "v")
    light = match(tab.join(heavy, "key", "left_anti"), ask.join(heavy, "key", "left_anti")).select("u", "v")
    # Heavy buckets: every row to its bucket's leader, one link per row at most.
    h_tab = materialise(tab.join(heavy, "key"), "heavy-table")
    h_ask = materialise(ask.join(heavy, "key"), "heavy-probe")
    star = (h_tab.select("fp", "lead").unionByName(h_ask.select("fp", "lead"))
            .filter(_near("fp", "lead", max_bits) & (F.col("fp") != F.col("lead")))
            .select(F.col("fp").alias("u"), F.col("lead").alias("v")))
    links = materialise(light.unionByName(star).distinct(), "fp-links")
    label = components(links)

    def labelled(rows: DataFrame) -> DataFrame:
        return (rows.join(label, F.col("fp") == F.col("node"), "left")
                .withColumn("c", F.coalesce("root", "fp")).drop("node", "root", "lead"))

    t, p = labelled(h_tab), labelled(h_ask)
    # What is left joins different components. In each bucket one side of the
    # pair is outside the bucket's largest component, so that component is
    # never paired with itself.
    main = (t.groupBy("key", "c").count().groupBy("key").agg(F.max_by("c", F.struct("count", "c")).alias("main")))
    t, p = t.join(main, "key"), p.join(main, "key")
    apart = F.expr("cu <> cv")
    rest = match(t.filter("c <> main").drop("main"), p.drop("main"), apart).select("u", "v").unionByName(
        match(t.filter("c = main").drop("main"), p.filter("c <> main").drop("main"), apart).select("u", "v"))
    return links.unionByName(rest)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, ``fp`` (signed long), ``component_id``
    (smallest id reachable over links, itself included), ``k1, k2`` (hash of id
    and text) and ``keeper`` (this row stands for its component).

    Null and word-less texts have fingerprint zero and link like any other.
    Null ids come after all others: a component of null ids only has a null
    component_id; the keeper is the row of the smallest id, among equal ids
    that of the smallest text hash. Repeated rows each appear, and all of the
    keeper's repeats are marked. Other columns are not read; an empty table
    gives an empty result.
    """
    if max_bits != MAX_BITS:
        raise ValueError(f"SPLITS serve a distance of {MAX_BITS} bits")
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    rows = materialise(docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"),
                                   fingerprint_column(F.col(text_col), n).alias("fp")), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull(), "id", "k1", "k2")).alias("first")
    fps = materialise(rows.groupBy("fp").agg(first), "distinct-fingerprints")
    label = components(_links(fps.select("fp"), max_bits, segments_for(fps.count())))
    named = with_heads(fps.withColumnRenamed("fp", "node"), label).select(F.col("node").alias("fp"), "head")
    # The files of repeated rows are far smaller than the rows, so ``rows`` is
    # not to be broadcast by their size.
    return rows.join(named.hint("merge"), "fp").select(
        F.col("id").alias(id_col), "fp", F.col("head.id").alias("component_id"), "k1", "k2",
        ((F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2"))).alias("keeper"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per component of near-duplicates, all columns kept,
    whatever their names.

    The row of the smallest id stays, among equal ids that of the smallest text
    hash, null ids after all others; of repeated rows one. Null and wordless
    texts are one component with whatever is near fingerprint zero; very long
    texts are read whole; an empty table stays empty.
    """
    n1, n2 = free_names(docs, "k1", "k2")
    keep = (simhash_components(docs, id_col, text_col).filter("keeper")
            .select(F.col("k1").alias(n1), F.col("k2").alias(n2)).distinct())
    k1, k2 = row_key(F.col(id_col), F.col(text_col))
    return (docs.withColumn(n1, k1).withColumn(n2, k2).join(keep, [n1, n2], "left_semi")
            .dropDuplicates([n1, n2]).drop(n1, n2))
