"""Steps that several readers share are computed once, and their tasks follow the data."""

import datetime as dt

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from queryset.flows import raw_tables
from queryset.narrative import texts
from queryset.registry import Tables
from vitalgrid import params as P
from vitalgrid.operators.lists import list_parts, visit_lists
from vitalgrid.operators.sizes import GroupSizes
from vitalgrid.plans import reasoning

T0 = dt.datetime(2024, 1, 3, 8)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    made = {
        "orders": ([(1, 7, "F", T0), (2, 7, "O", T0 + dt.timedelta(days=40)), (3, 8, "F", T0), (4, None, "O", T0)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz"),
        "lineitem": ([(1, 1, 2), (1, 2, 1), (1, 2, 1), (2, 3, 1), (2, 9, 1), (4, 1, 1)], "l_orderkey long, l_partkey long, l_linenumber int"),
        "part": ([(1, "B#1", "ring", 10), (2, "B#2", "bolt", 33), (3, "B#3", None, 40)], "p_partkey long, p_brand string, p_name string, p_size int"),
        "events": ([(1, T0, 7, "view", 1.0, "{}"), (2, T0 + dt.timedelta(hours=20), 7, "error", 2.0, "{}")],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return Tables(spark, str(folder))


def _reads(df, name):
    return any(name in f for f in df.inputFiles())


def test_texts_are_computed_once(tables, rows):
    found = texts(tables)
    assert not _reads(found, "lineitem") and not _reads(found, "orders")
    got = rows(found, "patient", "visit", "conditions", "medications", "procedures")
    assert (7, 1, "bolt;bolt;ring", "B#1", "bolt;bolt") in got and (7, 2, None, None, None) in got and (8, 3, None, None, None) in got


def test_raw_tables_join_the_lines_once(tables):
    raw = raw_tables(tables, P.III)
    assert not any(_reads(df, "lineitem") for df in (raw.prescriptions, raw.diagnoses, raw.procedures))
    assert raw.prescriptions.count() == 5


def test_one_staged_file_is_scored_by_many_tasks(spark, tmp_path):
    def load():
        return lambda frame: pd.DataFrame({"patient": frame["patient"], "answer": f"task {TaskContext.get().partitionId()}"})

    prompts = spark.range(64).coalesce(1).select(F.col("id").alias("patient"), F.lit("p").alias("prompt"))
    kept, _ = reasoning.reasoning(prompts, "Outcome", load, str(tmp_path / "out"), 4)
    assert kept.count() == 64 and kept.select("answer").distinct().count() > 1


def test_parts_of_lists_follow_the_data(spark):
    """A task's share of rows does not grow with the input when few partitions are configured."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        df = spark.range(200_000).select((F.col("id") % 40_000).alias("k"), F.md5(F.col("id").cast("string")).alias("t"))
        parts = list_parts(df, ["k"], {"l": "t"}, ["t"], part_size=3)
        assert parts.rdd.getNumPartitions() > 2 and parts.count() == 80_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_bytes_of_a_larger_table_refuse_nothing(spark, rows):
    """Sizes handed in are bounds: a bound above a cell is looked into, not an error."""
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, t string")
    sizes = GroupSizes(frozenset(["k"]), 2, 1 << 40)
    assert rows(visit_lists(df, ["k"], {"l": "t"}, ["t"], sizes=sizes)) == [(1, "a;b")]
