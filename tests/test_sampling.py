"""Samples, splits and pseudonyms: exact sizes, repeatable, independent of partitioning."""

import pytest
from pyspark.sql import functions as F

from vitalgrid.operators.sampling import extend_pseudonyms, pseudonym_map, pseudonymize, sample_exact, split_by_entity, split_labels, stratified_sample


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(1000).select(F.col("id").alias("patient"), (F.col("id") % 10 == 0).cast("long").alias("label"))


def sizes(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


@pytest.mark.parametrize(
    "total, share, backfill, want",
    [
        (200, 0.13, False, {1: 26, 0: 174}), (400, 0.5, False, {1: 100, 0: 200}), (400, 0.5, True, {1: 100, 0: 300}),
        (990, 0.05, True, {1: 90, 0: 900}), (5000, 0.5, True, {1: 100, 0: 900}),
    ],
)
def test_stratified(people, total, share, backfill, want):
    out = stratified_sample(people, "patient", "label", total, share, 42, backfill)
    assert sizes(out) == want and out.count() == out.distinct().count()


def test_same_rows_for_any_partitioning(people, rows):
    a = rows(stratified_sample(people.repartition(1), "patient", "label", 100, 0.2, 7))
    b = rows(stratified_sample(people.repartition(7, "label"), "patient", "label", 100, 0.2, 7))
    assert a == b and a != rows(stratified_sample(people, "patient", "label", 100, 0.2, 8))


def test_exact(people):
    assert sample_exact(people, "patient", 1000, 1).count() == 1000
    with pytest.raises(Exception, match="fewer ids"):
        sample_exact(people, "patient", 1001, 1).collect()


def test_split(people):
    visits = people.crossJoin(people.sparkSession.range(3).withColumnRenamed("id", "visit"))
    out = split_by_entity(visits, "patient", (0.7, 0.1), 42)
    counts = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count_distinct("patient").alias("n")).collect()}
    assert counts == {"train": 700, "val": 100, "test": 200} and out.count() == 3000
    assert out.groupBy("patient").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_split_sizes_use_double_arithmetic(spark):
    # 10 * 0.7 is 7.0 and 29 * 0.1 is 2.9000000000000004 in double arithmetic.
    for n in (1, 9, 10, 29, 143):
        out = split_labels(spark.range(n), "id", (0.7, 0.1), 42)
        got = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
        train, val = int(n * 0.7), int(n * 0.1)
        assert (got.get("train", 0), got.get("val", 0), got.get("test", 0)) == (train, val, n - train - val)


def test_pseudonyms(people, rows):
    m = pseudonym_map(people, "patient", 42)
    assert sorted(r[0] for r in m.select("new_id").collect()) == list(range(10_001, 11_001))
    out = pseudonymize(people, "patient", 42)
    assert out.columns == people.columns and sizes(out) == sizes(people)


def test_stored_pseudonyms_stay(spark, tmp_path):
    """A later load with more patients keeps all old numbers and repeats none."""
    path = str(tmp_path / "map")
    load = lambda lo, hi: spark.range(lo, hi).select(F.col("id").alias("patient"))
    first = {r[0]: r[1] for r in extend_pseudonyms(spark, path, load(0, 50).union(load(0, 50)), "patient", 42).collect()}
    assert sorted(first.values()) == list(range(10_001, 10_051)) and sorted(first.values()) != [first[i] for i in range(50)]
    more = load(30, 200).union(spark.createDataFrame([(None,)], "patient long"))
    second = {r[0]: r[1] for r in extend_pseudonyms(spark, path, more, "patient", 42).collect()}
    assert all(second[i] == n for i, n in first.items()) and sorted(second.values()) == list(range(10_001, 10_201))
    assert {r[0]: r[1] for r in extend_pseudonyms(spark, path, load(0, 200), "patient", 42).collect()} == second
    rows = pseudonymize(load(0, 3).withColumn("v", F.col("patient")), "patient", 42, path=path).collect()
    assert {r["v"]: r["patient"] for r in rows} == {i: second[i] for i in range(3)}
    spark.createDataFrame([(900, 10_001)], "patient long, new_id long").write.mode("append").parquet(path)
    with pytest.raises(ValueError):
        extend_pseudonyms(spark, path, load(0, 3), "patient", 42)


def test_pseudonyms_of_an_empty_first_load(spark, tmp_path):
    path = str(tmp_path / "map")
    none = spark.range(0).select(F.col("id").alias("patient"))
    assert extend_pseudonyms(spark, path, none, "patient", 1).count() == 0
    assert extend_pseudonyms(spark, path, spark.range(3).select(F.col("id").alias("patient")), "patient", 1).count() == 3
