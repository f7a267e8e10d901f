"""A key with a third of all rows: how the work is split."""

import pytest
from pyspark.sql import Window, functions as F

from vitalgrid.operators.lists import visit_lists
from vitalgrid.operators.ordered import add_hot_chunks, hot_keys, impute, neighbour, ordinal, prefix_sums
from vitalgrid.operators.sizes import group_sizes
from vitalgrid.operators.sampling import hash_rank
from vitalgrid.operators.visits import join_admissions

SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SMALL if spark.conf.get(k, None) is not None}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k in SMALL:
        spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


@pytest.fixture(scope="module")
def stays(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20_000)
    admit = F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") * 7919 % 80_000).cast("int"))
    return spark.range(0, 240_000, 1, 16).select(
        hot.alias("patient"), F.col("id").alias("visit"), admit.alias("admit"),
        (admit + F.make_dt_interval(hours=F.lit(5))).alias("discharge"),
    )


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan")[0]


def test_join_on_a_hot_patient_is_split(spark, stays, small_partitions):
    patients = spark.range(20_000).select(F.col("id").alias("patient"), (F.col("id") % 2).alias("sex"))
    joined = join_admissions(patients, stays, "patient")
    out = joined.groupBy("sex").agg(F.max("admit").alias("a"), F.max("discharge").alias("d"), F.sum("visit").alias("n"))
    assert "SortMergeJoin(skew=true)" in final_plan(out)


def test_hot_keys_are_few(stays):
    hot = hot_keys(stays, ["patient"], 1000)
    assert [r["patient"] for r in hot.collect()] == [7]


SHAPES = {
    "clustered times": lambda i: F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(i * 7919 % 400_000).cast("double")),
    "common start": lambda i: F.concat(F.lit("Brand#"), F.lpad((i * 7919 % 100_000).cast("string"), 6, "0")),
    "sparse ids": lambda i: F.xxhash64(i),
    "ties": lambda i: (i % 4).cast("long"),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_hot_groups_are_cut_by_rows(spark, shape):
    """A key with a third of all rows: chunks of bounded size, few of them, and the plain window's results."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
    rows = spark.range(0, 150_000, 1, 8).select(hot.alias("k"), SHAPES[shape](F.col("id")).alias("t"), "id")
    limit = 2000
    chunked = add_hot_chunks(rows, ["k"], ["t", "id"], None, limit)
    sizes = {r["_chunk"]: r["count"] for r in chunked.where("k = -1").groupBy("_chunk").count().collect()}
    assert sum(sizes.values()) == 50_000 and 0 not in sizes
    assert max(sizes.values()) <= 2 * limit and len(sizes) <= 2 * -(-50_000 // limit)
    assert chunked.where("k <> -1 and _chunk <> 0").isEmpty()
    order = Window.partitionBy("k").orderBy("t", "id")
    out = ordinal(rows, ["k"], ["t", "id"], size="n", hot_rows=limit)
    out = out.withColumns({"r": F.row_number().over(order), "m": F.count("*").over(Window.partitionBy("k"))})
    assert out.count() == 150_000 and out.where("ordinal <> r or n <> m").isEmpty()
    dense = ordinal(rows, ["k"], ["t"], "dense_rank", hot_rows=limit)
    assert dense.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("t"))).where("ordinal <> r").isEmpty()
    near = neighbour(rows, ["k"], ["t", "id"], {"before": "id"}, "lag", hot_rows=limit)
    assert near.withColumn("r", F.lag("id").over(order)).where("not before <=> r").isEmpty()
    gaps = rows.withColumn("v", F.when(F.col("id") % 7 == 0, F.col("id")))
    filled = impute(gaps, ["k"], ["t", "id"], ["v"], backward=False, hot_rows=limit).withColumnRenamed("v", "f")
    want = gaps.withColumn("w", F.last("v", ignorenulls=True).over(order)).select("id", "w")
    assert filled.join(want, "id").where("not f <=> w").isEmpty()
    sums = prefix_sums(rows, ["k"], ["t", "id"], {"s": F.col("id")}, totals=["s"], hot_rows=limit)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumns({"w": F.coalesce(F.sum("id").over(before), F.lit(0)), "t2": F.sum("id").over(Window.partitionBy("k"))})
    assert sums.where("s <> w or s_total <> t2").isEmpty()


def test_hot_and_plain_agree(stays):
    by_hot = ordinal(stays, ["patient"], ["admit", "visit"], size="n", hot_rows=1000)
    plain = ordinal(stays, ["patient"], ["admit", "visit"], size="n", hot_rows=10**9)
    cols = ["patient", "visit", "ordinal", "n"]
    assert by_hot.select(cols).exceptAll(plain.select(cols)).isEmpty()
    a = neighbour(stays, ["patient"], ["admit", "visit"], {"next": "admit"}, "lead", hot_rows=1000).select("visit", "next")
    b = neighbour(stays, ["patient"], ["admit", "visit"], {"next": "admit"}, "lead", hot_rows=10**9).select("visit", "next")
    assert a.exceptAll(b).isEmpty()


def test_cold_data_takes_one_exchange(spark, tmp_path):
    path = str(tmp_path / "cold")
    spark.range(10_000).selectExpr("id % 500 as patient", "id as t").write.parquet(path)
    out = neighbour(spark.read.parquet(path), ["patient"], ["t"], {"p": "t"}, "lag")
    plan = final_plan(out)
    # Nothing is hot, so the summary and its join are gone from the final plan.
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_list_of_a_hot_visit_is_whole(spark):
    df = spark.range(60_000).select((F.col("id") % 3 % 2).alias("k"), F.col("id").alias("seq"), F.col("id").cast("string").alias("s"))
    got = {r["k"]: r["l"] for r in visit_lists(df, ["k"], {"l": "s"}, ["seq"]).collect()}
    assert got[1].split(";") == [str(i) for i in range(60_000) if i % 3 == 1]
    assert len(got[0].split(";")) == 40_000


def test_list_of_drugs_with_a_common_start(spark):
    """A hot visit whose entries begin alike is joined in parts of bounded size; ties and equal rows stay."""
    name = F.concat(F.lit("Sodium chloride "), F.lpad((F.col("id") * 7919 % 9000).cast("string"), 5, "0"))
    df = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("k"), name.alias("drug"))
    limit = 1000
    parts = add_hot_chunks(df, ["k"], ["drug"], None, limit).where("k = 0").groupBy("_chunk").count()
    sizes = [r["count"] for r in parts.collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2 * limit
    got = {r["k"]: r["l"] for r in visit_lists(df, ["k"], {"l": "drug"}, ["drug"], part_rows=limit).collect()}
    assert got[0].split(";") == sorted(r["drug"] for r in df.where("k = 0").collect())
    assert len(got) == 10_001 and got[2] == "Sodium chloride 06838"


def test_list_too_large_for_a_cell_is_an_error(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id", F.lit("é" * 10).alias("s"))
    assert visit_lists(df, ["k"], {"l": "s"}, ["id"], cell_bytes=50 * 21).count() == 2
    with pytest.raises(ValueError, match="list_parts"):
        visit_lists(df, ["k"], {"l": "s"}, ["id"], cell_bytes=50 * 21 - 1)


def test_sizes_are_counted_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id % 3 as a", "id % 7 as b", "id as t").write.parquet(path)
    read = lambda: spark.read.schema("a long, b long, t long").parquet(path)
    tracker = spark.sparkContext.statusTracker()
    group = f"sizes-{tmp_path}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        sizes = group_sizes(read(), ["a"])
        assert sizes.rows == 334
        first = len(tracker.getJobIdsForGroup(group))
        assert first > 0 and group_sizes(read(), ["a"]) is sizes
        for out in (ordinal(read(), ["a"], ["t"]), neighbour(read(), ["a"], ["t"], {"p": "t"}, "lag"), impute(read(), ["a", "b"], ["t"], ["b"], sizes=sizes)):
            assert out.columns  # planned without a job
        assert len(tracker.getJobIdsForGroup(group)) == first
        # A bound above the limit says nothing about smaller groups: they are counted.
        ordinal(read(), ["a", "b"], ["t"], hot_rows=100, sizes=sizes)
        assert len(tracker.getJobIdsForGroup(group)) > first
    finally:
        spark.sparkContext.setJobGroup(None, None)


def test_hash_ranks_are_a_permutation(spark):
    ids = spark.range(30_000)
    ranks = hash_rank(ids, "id", 1)
    assert ranks.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first() == (30_000, 1, 30_000)
