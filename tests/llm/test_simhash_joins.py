"""Tables that Spark sizes too low (exploded, salted, repeated rows) are not
broadcast on the way to the SimHash components, however small they look."""

import re

import pytest
from pyspark.sql import functions as F

from dimforge.llm import components, simhash
from dimforge.llm.common import materialise


def plan_of(df) -> str:
    """The plan that ran: adaptive execution may change joins on the way."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def broadcast_joins(plan: str, key: str) -> list[str]:
    return [ln.strip() for ln in plan.splitlines() if re.search(rf"BroadcastHashJoin \[[^]]*\b{key}#", ln)]


@pytest.fixture(scope="module")
def fps(spark):
    """Pairs of fingerprints one bit apart, written as ``simhash_components`` does."""
    even = F.col("id").bitwiseAND(F.lit(-2))
    fp = F.when(F.col("id") % 2 == 0, F.xxhash64(even)).otherwise(F.xxhash64(even).bitwiseXOR(F.lit(1 << 40)))
    return materialise(spark.range(2000).select(fp.alias("fp"), F.struct(F.col("id")).alias("first")), "test-fps")


@pytest.mark.parametrize("split", simhash.SPLITS)
def test_probes_and_tables_are_not_broadcast(fps, split):
    links = simhash._links(fps.select("fp"), simhash.MAX_BITS, split)
    plan = plan_of(links)
    assert links.distinct().count() == 1000
    assert "Generate" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan


def test_heavy_buckets_are_matched_without_a_broadcast(fps, monkeypatch):
    monkeypatch.setattr(simhash, "HEAVY_BUCKET", 1)
    links = simhash._links(fps.select("fp"), simhash.MAX_BITS)
    # only the heavy buckets themselves are small; both matches of their rows, and that of the light ones, are merged
    assert not re.search(r"BroadcastHashJoin .*bit_count", plan_of(links))
    assert components.components(links).select("root").distinct().count() == 1000


def test_nodes_labels_and_salted_heads_are_not_broadcast(fps):
    label = components.components(simhash._links(fps.select("fp"), simhash.MAX_BITS))
    named = components.with_heads(fps.withColumnRenamed("fp", "node"), label)
    plan = plan_of(named)
    assert "__salt" in plan and not broadcast_joins(plan, "__salt") and not broadcast_joins(plan, "node")
    assert named.filter(F.col("head.id") == F.col("first.id").bitwiseAND(F.lit(-2))).count() == 2000


def test_repeated_rows_are_not_broadcast(spark):
    """50,000 rows in files of a few KB."""
    docs = spark.range(50_000).select(F.lit(7).alias("doc_id"), F.lit("the same few words in every row").alias("text"))
    found = simhash.simhash_components(docs)
    assert not broadcast_joins(plan_of(found), "fp")
    assert found.filter("keeper and component_id = 7").count() == 50_000
