"""Readers and writers."""

import uuid

import pytest
from pyspark.sql import functions as F

from vitalgrid.sources import jsonlines as JL, tables as TB

SCHEMA = "id long, text string"


def lines(spark, path, *rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)


def test_tolerant_lines(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    lines(spark, path, '{"id": 1, "text": "old"}', "", '{"id": 2, "text": "é\\n"}', '{"id": 1, "te', "   ", '{"id": 1, "text": "new"}', "[1, 2]")
    records, seen = JL.read_jsonl_tolerant(spark, path, SCHEMA, "id")
    assert rows(records) == [(1, "new"), (2, "é\n")]
    assert seen.get == {"read": 5, "skipped": 2}


def test_strict_lines(spark, tmp_path, rows):
    path = str(tmp_path / "a")
    df = spark.createDataFrame([(1, "日本"), (2, None)], SCHEMA)
    JL.write_jsonl(df, path)
    assert rows(JL.read_jsonl(spark, path, SCHEMA)) == [(1, "日本"), (2, None)]
    assert '{"id":1,"text":"日本"}' in [r[0] for r in spark.read.text(path).collect()]
    with pytest.raises(Exception):
        JL.read_jsonl(spark, str(tmp_path / "none"), SCHEMA)
    lines(spark, str(tmp_path / "bad"), '{"id": 1', '{"id": 2}')
    with pytest.raises(Exception):
        JL.read_jsonl(spark, str(tmp_path / "bad"), SCHEMA).collect()
    JL.write_jsonl(df.where("id > 9"), str(tmp_path / "empty"))
    with pytest.raises(FileNotFoundError):
        JL.read_jsonl(spark, str(tmp_path / "empty"), SCHEMA)


def test_append_resume(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    JL.append_new(df.where("id = 1"), path, "id")
    JL.append_new(df.withColumn("text", F.lit("later")), path, "id")
    JL.append_new(df, path, "id")
    assert rows(JL.read_appended(spark, path, SCHEMA)) == [(1, "a"), (2, "later")]


def test_append_takes_each_key_once_and_scores_it_once(spark, tmp_path, rows):
    from vitalgrid.operators.inference import score_batches

    path, log = str(tmp_path / "out"), tmp_path / "calls"
    log.mkdir()

    def load():
        def score(frame):
            (log / f"{uuid.uuid4().hex}").write_text(",".join(map(str, frame["id"])))
            return frame.assign(text=frame["text"].str.upper())

        return score

    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c"), (2, "z")], SCHEMA)
    JL.append_new(df.where("id = 1"), path, "id")
    scorer = lambda d: score_batches(d, load, SCHEMA, 2)
    out = JL.append_new(df, path, "id", transform=scorer, slices=3)
    assert out.count() == 3 and rows(out) == [(1, "a"), (2, "B"), (3, "C")]
    seen = [i for f in log.iterdir() for i in f.read_text().split(",")]
    assert sorted(seen) == ["2", "3"]
    JL.append_new(df, path, "id", transform=scorer)
    assert len([i for f in log.iterdir() for i in f.read_text().split(",")]) == 2


def test_append_resumes_after_a_broken_slice(spark, tmp_path, rows):
    path = str(tmp_path / "out")
    df = spark.range(40).select("id", F.col("id").cast("string").alias("text"))

    def fail_late(part):
        n = part.count()
        stored = JL.existing_or_none(spark, path, "id long")
        if stored is not None and stored.count() + n >= 40:
            raise RuntimeError("lost")
        return part

    with pytest.raises(RuntimeError):
        JL.append_new(df, path, "id", transform=fail_late, slices=4)
    assert 0 < JL.read_appended(spark, path, SCHEMA).count() < 40
    assert sorted(r.id for r in JL.append_new(df, path, "id", slices=4).collect()) == list(range(40))


def test_append_scans_its_input_once_and_shows_committed_slices_only(spark, tmp_path):
    """Killed inside the third of five slices: two are seen, and the second call scores what is left."""
    path, scans, scored = str(tmp_path / "out"), tmp_path / "scans", tmp_path / "scored"
    scans.mkdir(), scored.mkdir()

    def logged(folder, fail_at=None):
        folder = str(folder)

        def run(batches):
            for batch in batches:
                for i in batch.column("id").to_pylist():
                    if i == fail_at:
                        raise RuntimeError("lost")
                    with open(f"{folder}/{i}-{uuid.uuid4().hex}", "w"):
                        pass
                yield batch

        return run

    source = spark.range(0, 60, 1, 3).select("id", F.col("id").cast("string").alias("text")).mapInArrow(logged(scans), SCHEMA)
    slice_of = {r["id"]: r["s"] for r in spark.range(60).select("id", F.pmod(F.xxhash64("id"), F.lit(5)).alias("s")).collect()}
    last = max(i for i in slice_of if slice_of[i] == 2)
    scorer = lambda fail: lambda d: d.mapInArrow(logged(scored, fail), SCHEMA)
    with pytest.raises(Exception):
        JL.append_new(source, path, "id", transform=scorer(last), slices=5)
    assert len(list(scans.iterdir())) == 60
    seen = sorted(r["id"] for r in JL.read_appended(spark, path, SCHEMA).collect())
    assert seen == [i for i in range(60) if slice_of[i] < 2]
    # Half of a slice may lie there, without its line in the log.
    (tmp_path / "out" / "slices" / "torn").mkdir()
    (tmp_path / "out" / "slices" / "torn" / "part-0.json").write_text('{"id": 1, "text": "x"}\n{"id": 59, "te')
    for f in scored.iterdir():
        f.unlink()
    out = JL.append_new(source, path, "id", transform=scorer(None), slices=5)
    assert sorted(int(f.name.split("-")[0]) for f in scored.iterdir()) == [i for i in range(60) if slice_of[i] >= 2]
    assert sorted(map(tuple, out.collect())) == sorted((i, str(i)) for i in range(60))


def test_append_of_columns_without_an_order(spark, tmp_path):
    df = spark.sql("select k, map('a', k) as m, array(map('b', v)) as n from values (1, 5), (1, 4), (2, 7) as t(k, v)")
    out = JL.append_new(df, str(tmp_path / "out"), "k", slices=2)
    assert sorted((r["k"], r["m"], r["n"]) for r in out.collect()) == [(1, {"a": 1}, [{"b": 4}]), (2, {"a": 2}, [{"b": 7}])]


def test_append_to_plain_lines(spark, tmp_path, rows):
    """Lines written before, by any writer, count as done."""
    path = str(tmp_path / "out")
    JL.write_jsonl(spark.createDataFrame([(1, "old")], SCHEMA), path)
    out = JL.append_new(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, "id")
    assert rows(out) == [(1, "old"), (2, "b")]
    with pytest.raises(FileNotFoundError):
        JL.read_appended(spark, str(tmp_path / "none"), SCHEMA)


def test_damaged_parameters_give_the_default(spark, tmp_path):
    path = tmp_path / "p"
    TB.save_params(spark.createDataFrame([("t", 0.25)], "name string, value double"), str(path))
    assert TB.load_param(spark, str(path), "t", 0.5) == 0.25 and TB.load_param(spark, str(path), "u", 0.5) == 0.5
    assert TB.load_param(spark, str(tmp_path / "none"), "t", 0.5) == 0.5
    for f in path.glob("part-*"):
        f.write_bytes(b"not a table")
    for f in path.glob(".*crc"):
        f.write_bytes(b"")
    assert TB.load_param(spark, str(path), "t", 0.5) == 0.5


def test_csv_dialect(spark, tmp_path, rows):
    """A file as other programs write it, and a broken row."""
    schema = "id long, t string, z long"
    path = tmp_path / "a.csv"
    path.write_text('id,t,z\n1,"a ""q"" b, c",9\n2," two\nlines\n",8\n3,"",7\n4,,6\n5,back\\slash,5\n')
    want = [(1, 'a "q" b, c', 9), (2, " two\nlines\n", 8), (3, "", 7), (4, None, 6), (5, "back\\slash", 5)]
    df = TB.read_csv(spark, str(path), schema, multiline=True)
    assert rows(df) == want
    out = str(tmp_path / "b")
    TB.write_csv(df, out)
    assert rows(TB.read_csv(spark, out, schema, multiline=True)) == want
    import pandas as pd

    back = pd.concat(pd.read_csv(f, keep_default_na=False) for f in (tmp_path / "b").glob("part-*"))
    assert sorted(back["t"]) == sorted(t or "" for _, t, _ in want)
    bad = tmp_path / "c.csv"
    for line in ('1,"x",2,3', "1,x", "one,x,2"):
        bad.write_text(f"id,t,z\n{line}\n")
        with pytest.raises(Exception):
            TB.read_csv(spark, str(bad), schema, ["id", "t"]).collect()
    assert TB.read_csv(spark, str(bad), schema, mode="PERMISSIVE").count() == 1


def test_csv_round_trip(spark, tmp_path, rows):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, 1 / 3, "x;y"), (2, None, None)], "id long, v double, s string")
    TB.write_csv(df, path)
    assert rows(TB.read_csv(spark, path, "id long, v double, s string")) == [(1, 0.333333, "x;y"), (2, None, None)]
    assert TB.csv_header(spark, path, drop=["id"]) == ["v", "s"]
    assert TB.read_csv(spark, path, "id long, v double, s string", ["s"]).columns == ["s"]


def test_nan_becomes_null(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, float("nan")), (2, 5.0)], "id long, v double").write.parquet(path)
    assert TB.read_table(spark, path).agg(F.max("v")).first()[0] == 5.0


def test_params(spark, tmp_path):
    path = str(tmp_path / "p")
    assert TB.load_param(spark, path, "threshold", 0.5) == 0.5
    TB.save_params(spark.createDataFrame([("threshold", 0.31), ("empty", None)], "name string, value double"), path)
    assert TB.load_param(spark, path, "threshold", 0.5) == 0.31
    assert TB.load_param(spark, path, "alpha", 0.7) == 0.7 and TB.load_param(spark, path, "empty", 0.2) == 0.2


def test_sorted_export(spark):
    out = TB.sorted_export(spark.range(1000).repartition(7).selectExpr("(id * 7919) % 1000 as k"), ["k"])
    assert [r[0] for r in out.collect()] == list(range(1000))


ODD = ["plain", 'say ""q"", twice', "two\nlines", "\n", "a,b\n,c\n", '""\n""', "", None, "x" * 300, "é\n日本\n" * 5, "end \r\nof"]


def odd_file(path, n, seed=0, ending="\n"):
    import random

    rng = random.Random(seed)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(f"id,t,z{ending}")
        for i in range(n):
            t = rng.choice(ODD)
            f.write(f"{i},{'' if t is None else chr(34) + t + chr(34)},{i % 7}{ending}")


@pytest.mark.parametrize("block", [64, 1000, 20_000])
def test_quoted_breaks_are_read_by_many_tasks(spark, tmp_path, block):
    """Blocks of any size, also smaller than a record, give what one task reads from the whole file."""
    schema = "id long, t string, z long"
    for i, n in enumerate((1500, 0, 40)):
        odd_file(tmp_path / f"f{i}.csv", n, i)
    (tmp_path / "f3.csv").write_text("id,t,z\n\n7,\"last\nline\",1")  # an empty line, no line break at the end
    whole = spark.read.options(**TB.DIALECT, **TB.CELLS).csv(str(tmp_path), schema=schema, header=True, multiLine=True, mode="FAILFAST")
    expected = sorted(map(tuple, whole.collect()), key=str)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        from vitalgrid.sources.records import _lines

        lines = _lines(spark, str(tmp_path))
        assert lines.select("_file", "_block").distinct().count() >= 8 or block > 1000
        assert block > 1000 or lines.rdd.getNumPartitions() >= 8
        assert sorted(map(tuple, TB.read_csv(spark, str(tmp_path), schema, multiline=True).collect()), key=str) == expected
        assert len(expected) == 1541
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_breaks_with_carriage_returns(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_bytes(b'id,t\r\n1,"a\r\nb"\r\n2,c\r\n')
    assert rows(TB.read_csv(spark, str(path), "id long, t string", multiline=True)) == [(1, "a\r\nb"), (2, "c")]


def test_broken_quotes_and_headers(spark, tmp_path):
    schema = "id long, t string"
    path = tmp_path / "a.csv"
    for text in ('id,t\n1,"open\n2,b\n', 'id,t\n1,x"\n2,y"\n', "id,other\n1,x\n", "t,id\n1,x\n"):
        path.write_text(text)
        with pytest.raises(Exception):
            TB.read_csv(spark, str(path), schema, multiline=True).collect()
    path.write_text('id,t\n1,"a\nb"\none,c\n2,d,e\n3,f\n')
    read = lambda mode: TB.read_csv(spark, str(path), schema, multiline=True, mode=mode)
    assert sorted(map(tuple, read("DROPMALFORMED").collect())) == [(1, "a\nb"), (3, "f")]
    assert read("PERMISSIVE").count() == 4


def test_scratch_folders_go_with_their_block(spark, tmp_path):
    import os

    from vitalgrid.session import scratch, shared_folder

    kept = shared_folder(spark)
    spark.range(3).write.parquet(kept)
    with scratch(spark):
        with scratch(spark):
            shared_folder(spark)
        later = shared_folder(spark)
        spark.range(1).write.parquet(later)
    assert not os.path.exists(later)
    with pytest.raises(RuntimeError), scratch(spark):
        outer = shared_folder(spark)
        spark.range(3).write.parquet(outer)
        with scratch(spark):
            inner = shared_folder(spark)
            spark.read.parquet(outer).write.parquet(inner)
            spark.read.parquet(inner).write.parquet(str(tmp_path / "out"))
        assert not os.path.exists(inner) and os.path.exists(outer)
        shared_folder(spark)  # given, never written
        raise RuntimeError
    assert not os.path.exists(outer) and os.path.exists(kept) and spark.read.parquet(str(tmp_path / "out")).count() == 3
