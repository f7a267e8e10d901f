"""Hand cases for stays, windows, events and pivots."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vitalgrid.functions.timing import age_anchor, age_birth, los_days
from vitalgrid.operators.events import (
    events_in_windows, events_union, max_converted, max_of, pivot_items, select_items, sum_of_max, window_join,
)
from vitalgrid.operators.visits import gap_days, readmission, time_grid, visit_ordinal

T0 = dt.datetime(2020, 1, 1, 22, 30)
H = dt.timedelta(hours=1)
STAY = "patient long, visit long, admit timestamp_ntz, discharge timestamp_ntz"


def stays(spark, *spans):
    return spark.createDataFrame([(1, i + 1, a, d) for i, (a, d) in enumerate(spans)], STAY)


def test_grid_edges(spark, rows):
    df = stays(
        spark, (T0, T0), (T0, T0 - H), (T0, None), (T0, T0 + 12 * H), (T0, T0 + 12 * H + dt.timedelta(seconds=2)),
        (T0, T0 + dt.timedelta(milliseconds=900)), (T0, T0 + 12 * H + dt.timedelta(seconds=1)),
    )
    grid = time_grid(df, "admit", "discharge")
    assert rows(grid, "visit", "record") == [(4, 1), (5, 1), (5, 2), (7, 1), (7, 2)]
    assert rows(grid.where("visit = 5"), "record_start")[1][0] == T0 + 12 * H


def test_window_edges(spark, rows):
    visits = stays(spark, (T0, T0 + 13 * H))
    sec = dt.timedelta(seconds=1)
    times = [T0 - sec, T0, T0 + 12 * H - sec, T0 + 12 * H, T0 + 13 * H + sec, T0 + 24 * H - sec, T0 + 24 * H]
    data = [(1, 1, i, t) for i, t in enumerate(times)] + [(1, None, 99, T0)]
    events = spark.createDataFrame(data, "patient long, visit long, e int, ts timestamp_ntz")
    keys = ["patient", "visit"]
    placed = events_in_windows(visits, events, keys, "admit", "discharge", "ts")
    assert rows(placed, "e", "record") == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 2)]


def test_windows_without_events_stay(spark, rows):
    visits = stays(spark, (T0, T0 + 40 * H))
    grid = time_grid(visits, "admit", "discharge").select("patient", "visit", "record")
    events = spark.createDataFrame([(1, 1, 7, T0 + 13 * H), (1, 1, 8, T0 + 14 * H)], "patient long, visit long, e int, ts timestamp_ntz")
    out = window_join(grid, visits, events, ["patient", "visit"], "admit", "discharge", "ts", values=["e"])
    assert rows(out, "record", "e") == [(1, None), (2, 7), (2, 8), (3, None), (4, None)]


def test_window_join_has_no_nested_loop(spark):
    visits = stays(spark, (T0, T0 + 40 * H))
    grid = time_grid(visits, "admit", "discharge")
    events = spark.createDataFrame([(1, 1, 7, T0)], "patient long, visit long, e int, ts timestamp_ntz")
    out = window_join(grid, visits, events, ["patient", "visit"], "admit", "discharge", "ts", values=["e"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("hot_rows", [10**6, 40])
@pytest.mark.parametrize("start", [None, "record_start"])
def test_window_join_equals_range_join(spark, hot_rows, start):
    """Against the plain range join: events on borders, before, behind and in gaps; a hot visit; ties; NULL keys."""
    rng = random.Random(4)
    visits = spark.createDataFrame(
        [(p, v, T0 + rng.randint(0, 50) * H, T0 + rng.randint(40, 160) * H) for p in range(6) for v in range(2)],
        "patient long, visit long, admit timestamp_ntz, discharge timestamp_ntz",
    )
    grid = time_grid(visits, "admit", "discharge").where("record % 5 <> 3").withColumn("_us", F.col("record") * 10)
    data = []
    for i in range(900):
        p = 1 if i % 3 == 0 else rng.randint(0, 7)
        step = rng.choice([H, H / 2, dt.timedelta(seconds=1)])
        data.append((p if i % 50 else None, 0 if i % 3 == 0 else rng.randint(0, 1), i, T0 + rng.randint(-20, 200) * step))
    events = spark.createDataFrame(data + data[:5], "patient long, visit long, e int, ts timestamp_ntz")
    keys = ["patient", "visit"]
    out = window_join(grid, visits, events, keys, "admit", "discharge", "ts", values=["e"], start=start, hot_rows=hot_rows)
    assert out.columns == [*grid.columns, "e"]
    until = F.col("record_start") + F.make_dt_interval(hours=F.lit(12))
    g, x = grid.alias("g"), events.alias("x")
    on = (F.col("g.patient") == F.col("x.patient")) & (F.col("g.visit") == F.col("x.visit")) & (F.col("ts") >= F.col("record_start")) & (F.col("ts") < until)
    want = g.join(x, on, "left").select("g.*", "e")
    take = lambda d: sorted(map(tuple, d.select("patient", "visit", "record", "_us", "e").collect()), key=str)
    assert take(out) == take(want)


def test_window_join_shuffles_events_once(spark, tmp_path):
    path = str(tmp_path / "e")
    visits = stays(spark, (T0, T0 + 40 * H))
    spark.createDataFrame([(1, 1, 7, T0)], "patient long, visit long, e int, ts timestamp_ntz").write.parquet(path)
    grid = time_grid(visits, "admit", "discharge")
    out = window_join(grid, visits, spark.read.parquet(path), ["patient", "visit"], "admit", "discharge", "ts", values=["e"], start="record_start")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_pivot_values(spark, rows):
    data = [(1, 10, 90.0), (1, 11, 98.6), (1, 12, 20.0), (2, 10, 36.5), (2, 11, 200.0), (3, 12, 1.0), (3, 13, 2.0), (3, 14, 3.0)]
    df = spark.createDataFrame(data, "k long, item int, num double")
    spec = {
        "guarded": max_converted("item", "num", [10], [11], (30.0, 45.0)),
        "plain": max_converted("item", "num", [10], [11]),
        "total": sum_of_max("item", "num", [12, 13, 14]),
        "none": max_of("item", [99], "num"),
    }
    assert rows(pivot_items(df, ["k"], spec)) == [
        (1, 37.0, 90.0, None, None), (2, 36.5, 93.33, None, None), (3, None, None, 6.0, None),
    ]


def test_selection_and_union(spark, rows):
    df = spark.createDataFrame([(1, 1.0, None), (1, None, "x"), (1, None, None), (2, 1.0, "y")], "item int, num double, txt string")
    kept = select_items(df, "item", [1], ["num", "txt"])
    assert kept.count() == 2
    both = events_union(kept, df.where("item = 2").drop("txt"))
    assert rows(both, "item", "txt") == [(1, "x"), (1, None), (2, None)]


def test_readmission_limits(spark, rows):
    day = dt.timedelta(days=1)
    df = spark.createDataFrame(
        [
            (1, 1, T0, T0 + day), (1, 2, T0 + 31 * day, T0 + 32 * day), (1, 3, T0 + 63 * day, T0 + 70 * day),
            (2, 1, T0, T0 + 9 * day), (2, 2, T0 + day, T0 + 2 * day),
        ],
        STAY,
    )
    out = readmission(df, "patient", "visit", "admit", "discharge")
    # Exactly 30 days counts, 31 does not; an overlapping stay counts.
    assert rows(out, "patient", "visit", "readmission") == [(1, 1, 1), (1, 2, 0), (1, 3, 0), (2, 1, 1), (2, 2, 0)]


def test_gap_is_floored(spark, rows):
    day = dt.timedelta(days=1)
    df = spark.createDataFrame(
        [(1, 1, T0, T0 + H), (1, 2, T0 + 3 * H, T0 + 10 * day), (1, 3, T0 + 9 * day + 23 * H, T0 + 11 * day)], STAY
    )
    assert rows(gap_days(df, "patient", "visit", "admit", "discharge"), "visit", "gap_days") == [(1, None), (2, 0), (3, -1)]


def test_visit_ordinal_ties(spark, rows):
    df = spark.createDataFrame([(1, 5, T0, T0), (1, 6, T0, T0), (1, 4, T0 + H, T0)], STAY)
    assert rows(visit_ordinal(df, "patient", "admit"), "visit", "visit_id") == [(4, 2), (5, 1), (6, 1)]


@pytest.mark.parametrize("dob, age", [("1700-01-01", 90), ("1720-06-01", 90), ("1721-06-01", 299), ("1980-12-31", 40)])
def test_age_from_birth(spark, dob, age):
    df = spark.range(1).select(age_birth(F.lit(T0), F.lit(dob).cast("timestamp_ntz")).alias("a"))
    assert df.first()["a"] == age


def test_age_from_anchor_and_los(spark):
    df = spark.range(1).select(
        age_anchor(F.lit(T0), F.lit(50), F.lit(2018)).alias("a"),
        age_anchor(F.lit(T0), F.lit(None).cast("int"), F.lit(2018)).alias("b"),
        los_days(F.lit(T0), F.lit(T0 + 36 * H + dt.timedelta(minutes=7, seconds=12))).alias("c"),
    )
    assert df.first() == (52, None, 1.51)
