"""The reference's own three unit tests, re-expressed on dimforge operators."""

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from dimforge.operators import activity as ac
from dimforge.operators import graph as gr
from dimforge.operators import scd


def test_scd_generation(spark):
    src = spark.createDataFrame([
        Row(player_name="Michael Jordan", current_season=2001, scoring_class="Good"),
        Row(player_name="Michael Jordan", current_season=2002, scoring_class="Good"),
        Row(player_name="Michael Jordan", current_season=2003, scoring_class="Bad"),
        Row(player_name="Someone Else", current_season=2003, scoring_class="Bad"),
    ])
    got = scd.scd2_backfill(src, "player_name", "current_season", ["scoring_class"],
                            start="start_date", end="end_date")
    expected = spark.createDataFrame([
        Row(player_name="Michael Jordan", scoring_class="Good", start_date=2001, end_date=2002),
        Row(player_name="Michael Jordan", scoring_class="Bad", start_date=2003, end_date=2003),
        Row(player_name="Someone Else", scoring_class="Bad", start_date=2003, end_date=2003),
    ])
    assertDataFrameEqual(got, expected)


def test_team_vertex_first_row_wins(spark):
    teams = spark.createDataFrame([
        Row(team_id=1, abbreviation="GSW", nickname="Warriors", city="San Francisco", arena="Chase Center",
            yearfounded=1900, load_seq=0),
        Row(team_id=1, abbreviation="GSW", nickname="Bad Warriors", city="San Francisco", arena="Chase Center",
            yearfounded=1900, load_seq=1),
    ])
    got = gr.vertex_dedup(teams, "load_seq").collect()
    assert len(got) == 1
    r = got[0]
    assert (r.identifier, r.type) == (1, "team")
    assert r.properties == {"abbreviation": "GSW", "nickname": "Warriors", "city": "San Francisco",
                            "arena": "Chase Center", "year_founded": "1900"}


def test_monthly_site_hits_pick(spark):
    src = spark.createDataFrame([
        ("2023-03-01", [0, 1, 3], "2023-03-01"),
        ("2023-03-01", [1, 2, 3], "2023-03-01"),
        ("2023-04-01", [], "2023-03-01"),
        ("2023-04-01", [], ""),
    ], "month_start string, hit_array array<bigint>, date_partition string")
    src = src.withColumn("date_partition", F.to_date(F.nullif("date_partition", F.lit(""))))
    got = ac.metric_array_pick(src, "hit_array", [0, 1, 2],
                               ["num_hits_first_day", "num_hits_second_day", "num_hits_third_day"],
                               ds="2023-03-01")
    expected = spark.createDataFrame([("2023-03-01", 1, 3, 6), ("2023-04-01", 0, 0, 0)],
                                     "month_start string, num_hits_first_day bigint, "
                                     "num_hits_second_day bigint, num_hits_third_day bigint")
    assertDataFrameEqual(got, expected)


def test_dates_are_dates(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 13, 5))], "user_id bigint, event_time timestamp_ntz")
    got = ac.dates_active_backfill(ev, "user_id", "event_time", "2024-01-02").collect()[0]
    assert got.dates_active == [dt.date(2024, 1, 2)]
