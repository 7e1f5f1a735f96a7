"""Range look-up, as-of look-up, splice, bitmaps, merge levels, life cycle, pruned bucket join."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dimforge.operators import activity as ac
from dimforge.operators import lifecycle as lc
from dimforge.operators import scd
from dimforge.operators.levels import MergeLevels, first_copies
from dimforge.operators.published import AuditError
from dimforge.operators.ranges import CHUNK_BITS, range_blocks, range_lookup
from dimforge.plans.layout import pruned_order_lines
from dimforge.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_lookup_matches_brute_force(spark):
    rng = random.Random(4)
    size = 1 << CHUNK_BITS
    ranges = [(i, lo, lo + rng.choice([0, 1, 7, 16, 255, 5000, size, 3 * size]), f"v{i}")
              for i, lo in enumerate(rng.choices(range(0, 2 * size, 37), k=120))]
    ranges += [(900, 0, 0, "zero"), (901, -5, 3, "below"), (902, 9, 8, "empty"), (903, None, 4, "null"), (904, 4, None, "null"),
               (905, ranges[0][1], ranges[0][2], "twin"), (906, size - 1, size, "edge")]
    numbers = [None, -1, 0, 3, 4, size - 1, size, size + 1, 9 * size, 1 << 40] + [rng.randrange(6 * size) for _ in range(400)]
    numbers += [r[1] for r in ranges if r[1] is not None] + [r[2] for r in ranges if r[2] is not None]
    blocks = range_blocks(spark.createDataFrame(ranges, "id long, lo long, hi long, v string"), "lo", "hi", ["v"], "id")
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "k long, n long").repartition(4)
    found = range_lookup(rows, F.col("n"), blocks)

    def brute(n):
        fits = [] if n is None or n < 0 else [(hi - max(lo, lo), lo, i, v) for i, lo, hi, v in ranges
                                              if lo is not None and hi is not None and lo <= n <= hi]
        return min(fits)[3] if fits else None

    assert {r.k: r.v for r in found.collect()} == {i: brute(n) for i, n in enumerate(numbers)}
    assert found.count() == len(numbers)
    # one block per number, and no range condition in the join
    assert blocks.table.groupBy("level", "block").count().filter("count > 1").isEmpty()
    joins = [ln for ln in plan(found).splitlines() if "Join" in ln]
    assert joins and not any("<=" in ln or ">=" in ln for ln in joins)


def test_range_lookup_without_ranges(spark):
    blocks = range_blocks(spark.createDataFrame([], "id long, lo long, hi long, v string"), "lo", "hi", ["v"], "id")
    rows = spark.createDataFrame([(1,), (None,)], "n long")
    assert [r.v for r in range_lookup(rows, F.col("n"), blocks).collect()] == [None, None]


def test_range_blocks_rank_many_overlapping_ranges_by_block(spark, monkeypatch):
    from dimforge.operators import ranges as ra
    written, write = [], ra.replace_table
    monkeypatch.setattr(ra, "replace_table", lambda s, df, name: written.append(df) or write(s, df, name))
    n = 300
    rows = [(i, i % 40, 5000 - 3 * (i // 2), f"v{i}") for i in range(n)]
    blocks = range_blocks(spark.createDataFrame(rows, "id long, lo long, hi long, v string"), "lo", "hi", ["v"], "id")
    # a block keeps one range before segments meet it, so overlaps do not multiply
    grouped = [ln for df in written for ln in df._jdf.queryExecution().optimizedPlan().toString().splitlines()
               if "Aggregate [level#" in ln and "block#" in ln]
    assert grouped
    found = range_lookup(spark.range(5100).withColumnRenamed("id", "n"), F.col("n"), blocks)

    def brute(x):
        fits = [(hi - lo, lo, i, v) for i, lo, hi, v in rows if lo <= x <= hi]
        return min(fits)[3] if fits else None

    assert {r.n: r.v for r in found.collect()} == {x: brute(x) for x in range(5100)}


def test_asof_join_has_no_range_condition_and_takes_long_histories(spark):
    n = 100_000
    versions = spark.range(n).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("start_season"),
                                     F.col("id").cast("int").alias("end_season"), F.concat(F.lit("v"), "id").alias("c"))
    facts = spark.range(5000).select(F.lit(1).alias("fk"), (F.col("id") * 19).cast("int").alias("yr"))
    facts = facts.unionByName(spark.createDataFrame([(1, n + 5), (2, 3), (None, 3), (1, None), (1, -4)], "fk int, yr int"))
    j = scd.scd_asof_join(facts, versions, "fk", "k", "yr")
    assert "BETWEEN" not in plan(j).upper() and not any("Join" in ln and ("<=" in ln or ">=" in ln) for ln in plan(j).splitlines())
    got = {(r.fk, r.yr): r.c for r in j.collect()}
    assert len(got) == 5005 and all(got[1, i * 19] == f"v{i * 19}" for i in range(5000))
    assert [got[k] for k in ((1, n + 5), (2, 3), (None, 3), (1, None), (1, -4))] == [None] * 5


def test_asof_join_with_gaps_and_chunks(spark):
    rng = random.Random(2)
    versions, at = [], 0
    for i in range(60):
        at += rng.randrange(1, 90)
        end = at + rng.randrange(0, 60)
        versions.append(("a", at, end, None if i % 7 == 0 else f"v{i}"))
        at = end
    facts = [("a", p) for p in range(0, at + 100, 3)] * 2
    j = scd.scd_asof_join(spark.createDataFrame(facts, "fk string, yr int"),
                          spark.createDataFrame(versions, "k string, start_season int, end_season int, c string"), "fk", "k", "yr")
    got = {(r.yr, r.start_season, r.c) for r in j.collect()}
    want = {(p, *next(((s, c) for _, s, e, c in versions if s <= p <= e), (None, None))) for _, p in facts}
    assert got == want and j.count() == len(facts)


def test_splice_in_any_order_is_the_backfill(spark):
    rng = random.Random(6)
    rows = [(k, p, rng.choice(["x", "y", None])) for k in ("a", "b", "c") for p in range(2000, 2009) if rng.random() < 0.8]
    schema = "k string, p int, v string"
    df = spark.createDataFrame(rows, schema)
    want = sorted(map(str, scd.scd2_backfill(df, "k", "p", ["v"]).collect()))
    for seed in range(3):
        order = list(range(2000, 2009))
        random.Random(seed).shuffle(order)
        stored = scd.scd2_history(spark.createDataFrame([], schema), "k", "p", ["v"])
        for p in order:
            stored = scd.scd2_splice(stored, df.filter(F.col("p") == p), "k", "p", ["v"]).checkpoint()
        assert sorted(map(str, stored.drop("periods").select("k", "v", "start_season", "end_season").collect())) == \
            sorted(map(str, scd.scd2_backfill(df, "k", "p", ["v"]).select("k", "v", "start_season", "end_season").collect()))
    assert want
    # the same values again, and a past period corrected for one key
    again = scd.scd2_splice(stored, df.filter("p = 2004"), "k", "p", ["v"])
    assert sorted(map(str, again.collect())) == sorted(map(str, stored.select(*again.columns).collect()))
    fixed = scd.scd2_splice(stored, spark.createDataFrame([("a", 2004, "z")], schema), "k", "p", ["v"])
    rows2 = [r for r in rows if (r[0], r[1]) != ("a", 2004)] + [("a", 2004, "z")]
    assert sorted(map(str, fixed.select("k", "v", "start_season", "end_season").collect())) == \
        sorted(map(str, scd.scd2_backfill(spark.createDataFrame(rows2, schema), "k", "p", ["v"]).select("k", "v", "start_season", "end_season").collect()))


def test_splice_moves_rows_once_and_keeps_streaks_without_a_key(spark):
    schema = "k string, v string, start_season int, end_season int, periods array<int>"
    stored = spark.createDataFrame([("a", "x", 2001, 2003, [2001, 2002, 2003]), (None, "x", 2001, 2001, [2001]),
                                    ("b", None, 2001, 2001, [2001])], schema)
    new = spark.createDataFrame([("a", 2002, "y"), (None, 2002, "x"), ("b", 2002, None)], "k string, p int, v string")
    got = scd.scd2_splice(stored, new, "k", "p", ["v"])
    assert {(r.k, r.v, r.start_season, r.end_season) for r in got.collect()} == {
        ("a", "x", 2001, 2001), ("a", "y", 2002, 2002), ("a", "x", 2003, 2003), (None, "x", 2001, 2001),
        (None, "x", 2002, 2002), ("b", None, 2001, 2002)}
    assert got.count() == 6
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(scd.scd2_splice(stored, new, "k", "p", ["v"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # one exchange by key (and one of the streaks without a key), no join
    assert p.count("Exchange hashpartitioning") == 1 and "Join" not in p


def test_bitmaps_merge_over_days_and_hosts(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i % 70_000 if i % 9 else None, "h%d" % (i % 3), t0 + dt.timedelta(hours=i % 400)) for i in range(3000)]
    e = spark.createDataFrame(rows, "user_id long, host string, event_time timestamp_ntz")
    sets = ac.visitor_bitmaps(e, ["host"], "event_time", "user_id")
    assert ac.visitors(sets, [F.lit("all").alias("x")]).first().visitors == e.select("user_id").distinct().count() - 1
    week = F.date_trunc("week", F.to_date("event_time")).cast("date").alias("w")
    want = {(r.host, r.w): r.n for r in e.filter("user_id is not null").groupBy("host", week).agg(F.countDistinct("user_id").alias("n")).collect()}
    got = ac.visitors(sets, ["host", F.to_date(F.date_trunc("week", "date")).alias("w")])
    assert {(r.host, r.w): r.visitors for r in got.collect()} == want


def test_24_hourly_loads_rewrite_one_level_each(spark):
    rng = random.Random(1)
    schema = "k long, v string, first_seen int, n_copies long"
    hours = [[(rng.randrange(15), f"{h}.{i}", h * 60 + i, 1) for i in range(rng.randrange(0, 6))] for h in range(24)]
    levels = MergeLevels(spark, scratch_path(spark, "levels"), first_copies("k", ["v"]))
    for h, rows in enumerate(hours):
        before = levels.table.manifest()["partitions"]
        if h == 5:      # a load that fails changes nothing
            with pytest.raises(AuditError):
                staged = levels.table.stage(spark.createDataFrame(rows, schema).withColumn("level", F.lit(0)), [0])
                levels.table.audit(staged, {"never": lambda df: False})
            assert levels.table.manifest()["partitions"] == before
        levels.load(h, spark.createDataFrame(rows, schema))
        after = levels.table.manifest()["partitions"]
        changed = [v for v in after if after[v] != before.get(v)]
        assert sum(after[v]["rows"] > 0 for v in changed) <= 1 and len(after) <= 6
        if h in (3, 11):  # a rerun of an hour is harmless
            levels.load(h, spark.createDataFrame(rows, schema))
            assert levels.table.manifest()["partitions"] == after
    every = spark.createDataFrame([r for rows in hours for r in rows], schema)
    assert sorted(map(str, levels.read().collect())) == sorted(map(str, first_copies("k", ["v"])(every).collect()))


def files_of(spark, table):
    rows = spark.table(table).select("day", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_modification_time").alias("t"))
    out = {}
    for r in rows.distinct().collect():
        out.setdefault(r.day, set()).add((r.f, r.t))
    return out


def test_only_aged_partitions_change(spark):
    name = f"cycle_{scratch_path(spark, 't').rsplit('-', 1)[-1]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    rows = [(i, i % 3 if i % 5 else None, dt.date(2024, 1, 1 + i % 20)) for i in range(200)]
    live = lc.create_by_day(spark, spark.createDataFrame(rows, "id long, user_id long, day date"), f"{name}.facts", "day")
    stripped, before = f"{name}.stripped", files_of(spark, live)
    aged = lc.strip_aged(spark, live, stripped, "day", "2024-01-20", 14, ["user_id"])
    assert aged == [dt.date(2024, 1, d) for d in range(1, 6)]
    after = files_of(spark, live)
    assert after == {d: f for d, f in before.items() if d not in aged}
    assert spark.table(stripped).count() == 50 and "user_id" not in spark.table(stripped).columns
    # a second run finds nothing; a stop before the drop is mended by a run
    kept = files_of(spark, stripped)
    assert lc.strip_aged(spark, live, stripped, "day", "2024-01-20", 14, ["user_id"]) == [] and files_of(spark, stripped) == kept
    first = spark.createDataFrame([r for r in rows if r[2] == aged[0]], "id long, user_id long, day date")
    first.write.insertInto(live)
    assert lc.strip_aged(spark, live, stripped, "day", "2024-01-20", 14, ["user_id"]) == [aged[0]]
    assert spark.table(stripped).count() == 50
    assert {d: f for d, f in files_of(spark, stripped).items() if d != aged[0]} == {d: f for d, f in kept.items() if d != aged[0]}
    assert lc.retain(spark, live, "day", "2024-01-20", 3) == [dt.date(2024, 1, d) for d in range(6, 18)]
    assert sorted(files_of(spark, live)) == [dt.date(2024, 1, d) for d in (18, 19, 20)]


def test_pruned_bucket_join_plan(spark):
    text = plan(pruned_order_lines(spark, SF_SMALL))
    assert text.lower().count("dynamicpruning") >= 2
    assert "Exchange hashpartitioning" not in text and text.count("Bucketed: true") >= 2


def test_streak_positions_keep_no_second_copy_of_the_rows(spark):
    from dimforge.operators import common
    from dimforge.plans import load_all
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(1000).selectExpr("id", "id % 3 AS k", "id div 10 AS day", "CASE WHEN id % 5 > 0 THEN id % 7 = 0 END AS f")
        p = plan(common.sequence_positions(df, "k", "day", ["id"], "f"))
        assert "Aggregate" not in p      # day totals are read off the windows
        facts = plan(load_all()["fact_conform"][0](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # the group limit, and its sort, stand behind the shuffle by game, and no other shuffle follows
    below = facts[facts.rindex("WindowGroupLimit"):]
    assert below.index("Exchange hashpartitioning(game_id") > 0 and facts[:facts.rindex("WindowGroupLimit")].count("hashpartitioning(game_id, ") == 0


def test_positions_with_null_keys_and_flags(spark):
    from dimforge.operators import common
    rows = [("a", 1, 1, True), ("a", 1, 2, None), ("a", 2, 1, True), (None, 1, 1, False), (None, 3, 2, True), ("b", None, 1, None)]
    for kind in ("boolean", "int"):
        df = spark.createDataFrame([(k, d, i, f if kind == "boolean" or f is None else int(f)) for k, d, i, f in rows],
                                   f"k string, day int, id int, f {kind}")
        got = common.sequence_positions(df, "k", "day", ["id"], "f")
        assert got.columns == ["k", "day", "id", "f", "_pos", "_cnt"]
        assert {(r.k, r.day, r.id, r["_pos"], r["_cnt"]) for r in got.collect()} == {
            ("a", 1, 1, 1, 1), ("a", 1, 2, 2, 1), ("a", 2, 1, 3, 2), (None, 1, 1, 1, 0), (None, 3, 2, 2, 1), ("b", None, 1, 1, None)}
