"""Chunked operators against plain windows, with a hot key, small chunks and shuffled input."""

import random

import pytest
from pyspark.sql import Window, functions as F

from vitalgrid.operators.ordered import (
    block_means, first_row, first_values, head_n, impute, last_row, last_visit_first_row, neighbour, ordinal,
    position01, prefix_sums, truncate_after_last,
)


@pytest.fixture(scope="module", params=[1, 7])
def data(request, spark):
    """A third of all rows belongs to one key; values have gaps, order values have ties."""
    rng = random.Random(3)
    out = []
    for i in range(900):
        key = 1 if i % 3 == 0 else rng.randrange(2, 40)
        out.append((key, rng.randrange(-200, 4000), i, rng.random() * 100 if rng.random() < 0.4 else None, rng.choice([None, "x", "y"])))
    rng.shuffle(out)
    df = spark.createDataFrame(out, "k long, t long, i long, v double, s string").repartition(request.param)
    return df.persist()


def W():
    return Window.partitionBy("k").orderBy("t", "i")


def same(df, a, b):
    return df.where(~F.col(a).eqNullSafe(F.col(b))).count() == 0


@pytest.mark.parametrize("hot", [None, 30, 1000])
@pytest.mark.parametrize("stride", [1, 50, 10_000])
def test_row_number_and_size(data, stride, hot):
    out = ordinal(data, ["k"], ["t", "i"], size="n", stride=stride, hot_rows=hot)
    out = out.withColumns({"want": F.row_number().over(W()), "m": F.count("*").over(Window.partitionBy("k"))})
    assert out.count() == 900 and same(out, "ordinal", "want") and same(out, "n", "m")


@pytest.mark.parametrize("stride", [1, 64])
@pytest.mark.parametrize("hot", [None, 30, 1000])
def test_dense_rank(data, stride, hot):
    out = ordinal(data, ["k"], ["t"], "dense_rank", size="n", stride=stride, hot_rows=hot)
    sizes = data.groupBy("k").agg(F.count_distinct("t").alias("want_n"))
    assert same(out.join(sizes, "k"), "n", "want_n")
    out = out.withColumn("want", F.dense_rank().over(Window.partitionBy("k").orderBy("t")))
    assert same(out, "ordinal", "want")


@pytest.mark.parametrize("side, plain", [("lag", F.lag), ("lead", F.lead)])
@pytest.mark.parametrize("hot", [None, 30, 1000])
def test_neighbour(data, side, plain, hot):
    out = neighbour(data, ["k"], ["t", "i"], {"nt": "t", "nv": "v"}, side, stride=30, hot_rows=hot)
    out = out.withColumns({"wt": plain("t").over(W()), "wv": plain("v").over(W())})
    assert same(out, "nt", "wt") and same(out, "nv", "wv")


@pytest.mark.parametrize("forward, backward", [(True, True), (True, False), (False, True)])
@pytest.mark.parametrize("hot", [None, 30, 1000])
def test_impute(data, forward, backward, hot):
    split = impute(data, ["k"], ["t", "i"], ["v", "s"], forward, backward, stride=25, hot_rows=hot)
    whole = impute(data, ["k"], ["t", "i"], ["v", "s"], forward, backward, bound=900)
    pairs = split.join(whole.select("i", F.col("v").alias("v2"), F.col("s").alias("s2")), "i")
    assert pairs.count() == 900 and same(pairs, "v", "v2") and same(pairs, "s", "s2")
    kept = split.join(data.select("i", F.col("v").alias("v0")), "i").where("v0 is not null and v0 <> v")
    assert kept.count() == 0
    if forward and not backward:
        want = data.withColumn("w", F.last("v", ignorenulls=True).over(W())).select("i", "w")
        assert same(split.join(want, "i"), "v", "w")


def test_impute_bounded_has_one_exchange(spark):
    rows = spark.range(100).selectExpr("id % 7 as k", "id as t", "id as i", "id as v", "id as s").repartition(5)
    plan = impute(rows, ["k"], ["t", "i"], ["v", "s"], bound=900)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


@pytest.mark.parametrize("strides", [[500.0], [500.0, 20.0], [1000.0, 100.0, 10.0]])
@pytest.mark.parametrize("hot", [None, 30, 1000])
def test_prefix_sums(data, strides, hot):
    out = prefix_sums(data, ["k"], ["t", "i"], {"p": F.col("i"), "c": F.lit(1)}, strides, totals=["c"], hot_rows=hot)
    before = W().rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumns(
        {
            "wp": F.coalesce(F.sum("i").over(before), F.lit(0)), "wc": F.coalesce(F.count("*").over(before), F.lit(0)),
            "wt": F.count("*").over(Window.partitionBy("k")),
        }
    )
    assert out.count() == 900 and same(out, "p", "wp") and same(out, "c", "wc") and same(out, "c_total", "wt")


def test_prefix_sums_without_keys(data):
    out = prefix_sums(data, [], ["t", "i"], {"c": F.lit(1)}, [100.0])
    assert sorted(r[0] for r in out.select("c").collect()) == list(range(900))


@pytest.mark.parametrize("length, stride", [(1, 1), (3, 3), (5, 8), (40, 64)])
def test_block_means(data, length, stride):
    numbered = ordinal(data, ["k"], ["t", "i"])
    out = block_means(numbered, ["k"], "ordinal", ["v"], length, stride)
    frame = Window.partitionBy("k").orderBy("ordinal").rowsBetween(0, length - 1)
    want = numbered.withColumns({"m": F.avg("v").over(frame), "n": F.count("*").over(frame)}).where(F.col("n") == length)
    both = out.join(want, ["k", "ordinal"])
    assert out.count() == want.count() == both.count()
    assert both.where(~F.round("mean_v", 8).eqNullSafe(F.round("m", 8))).count() == 0


def test_block_longer_than_stride_is_refused(data):
    with pytest.raises(ValueError):
        block_means(ordinal(data, ["k"], ["t", "i"]), ["k"], "ordinal", ["v"], 9, 8)


def test_text_order(spark, rows):
    words = ["b", "aa", "", "ab", "é", "abcz", "abca", None, "z"]
    df = spark.createDataFrame([(1, w) for w in words], "k long, w string")
    out = ordinal(df, ["k"], ["w"]).withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("w")))
    assert same(out, "ordinal", "want")


def test_positions(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, 1), (2, 2), (2, 9)], "k long, t long")
    assert rows(position01(df, ["k"], ["t"]), "k", "t", "pos") == [(1, 5, 1.0), (2, 1, 0.0), (2, 2, 0.5), (2, 9, 1.0)]


def test_edges(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, 2, None), (1, 1, 1, "a"), (1, 2, 4, "b"), (1, 2, 3, None), (2, 1, 1, None)], "k long, visit long, t long, s string"
    )
    assert rows(first_row(df, ["k"], ["t"]), "k", "s") == [(1, "a"), (2, None)]
    assert rows(last_row(df, ["k"], ["t"]), "k", "s") == [(1, "b"), (2, None)]
    assert rows(last_visit_first_row(df, "k", "visit", ["t"]), "k", "t", "s") == [(1, 3, None), (2, 1, None)]
    assert rows(first_values(df, ["k", "visit"], ["t"], ["s"])) == [(1, 1, "a"), (1, 2, "b"), (2, 1, None)]
    assert rows(head_n(df, ["k"], ["t"], 2), "k", "t") == [(1, 1), (1, 2), (2, 1)]
    plan = head_n(df, ["k"], ["t"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_truncate(spark, rows):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (1, 3, 0), (2, 1, 0), (2, 2, 0)], "k long, visit long, f long")
    assert rows(truncate_after_last(df, "k", "visit", "f"), "k", "visit") == [(1, 1), (1, 2), (2, 1), (2, 2)]
