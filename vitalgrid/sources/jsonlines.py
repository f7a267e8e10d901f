"""JSON lines: strict and tolerant readers, writers, append and resume."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from vitalgrid.operators.joins import not_done
from vitalgrid.session import shared_folder


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, mode: str = "FAILFAST") -> DataFrame:
    """Strict reader: a missing or empty input, or a broken line, is an error."""
    df = spark.read.schema(_struct(schema)).option("mode", mode).json(path)
    if df.isEmpty():
        raise FileNotFoundError(f"{path} holds no record")
    return df


def lines_with_position(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their place in the input: (value, position).

    File, block offset and the line's place inside the block order all lines
    without numbering them in one task.
    """
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return spark.read.text(path).select("value", position.alias("position"))


def parse_tolerant(lines: DataFrame, schema: T.StructType | str, text: str = "value") -> DataFrame:
    """Parse each non-blank line; ``record`` is NULL for a broken one."""
    wanted = _struct(schema)
    names = wanted.fieldNames()
    bad = "_broken"
    full = T.StructType([*wanted.fields, T.StructField(bad, T.StringType())])
    parsed = F.from_json(F.col(text), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    rows = lines.where(F.col(text).rlike(r"\S")).withColumn("_p", parsed)
    good = F.col("_p").isNotNull() & F.col(f"_p.{bad}").isNull()
    return rows.withColumn("record", F.when(good, F.struct(*[F.col(f"_p.{n}").alias(n) for n in names]))).drop("_p")


def read_jsonl_tolerant(
    spark: SparkSession, path: str, schema: T.StructType | str, key: str
) -> tuple[DataFrame, Observation]:
    """Skip blank and broken lines; the last record of a key wins.

    Returns the records and an observation with ``read`` and ``skipped`` line
    counts, filled by the first action on the records.
    """
    parsed = parse_tolerant(lines_with_position(spark, path), schema)
    seen = Observation()
    parsed = parsed.observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col("record").isNull()).alias("skipped")
    )
    good = parsed.where(F.col("record").isNotNull() & F.col("record")[key].isNotNull())
    last = good.groupBy(F.col("record")[key].alias("_k")).agg(F.max_by("record", "position").alias("_r"))
    return last.select("_r.*"), seen


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", keep_nulls: bool = True) -> None:
    """One JSON object per row; characters outside ASCII are written as they are."""
    df.write.mode(mode).option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


#: Beside the plain lines of an output, slices lie in folders of their own, and one line each in the log of commits.
SLICES, COMMITS = "slices", "_commits"
STAGED_SLICE = "_staged_slice"


def _or_none(df: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return df()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed_paths(spark: SparkSession, path: str) -> list[str]:
    """The folders of an output's committed slices: one line of the log each."""
    log = _or_none(lambda: spark.read.schema("slice string").json(f"{path}/{COMMITS}"))
    return [] if log is None else sorted(f"{path}/{SLICES}/{r['slice']}" for r in log.distinct().collect())


def existing_or_none(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """The output's good lines, or None where there is no output yet.

    Plain lines count as they are; of slices only the committed ones are seen.
    """
    reader = lambda: spark.read.schema(_struct(schema)).option("mode", "DROPMALFORMED")
    plain = _or_none(lambda: reader().option("pathGlobFilter", "*.json").json(path))
    slices = committed_paths(spark, path)
    done = reader().json(slices) if slices else None
    if plain is None or done is None:
        return plain if done is None else done
    return plain.unionByName(done)


def _ordering(schema: T.StructType, name: str) -> Column:
    """A form of a column that has an order: maps and what holds them as text."""

    def holds_map(t: T.DataType) -> bool:
        inner = [t.elementType] if isinstance(t, T.ArrayType) else [f.dataType for f in t] if isinstance(t, T.StructType) else []
        return isinstance(t, (T.MapType, T.VariantType)) or any(holds_map(x) for x in inner)

    return F.to_json(F.struct(name)) if holds_map(schema[name].dataType) else F.col(name)


def append_new(
    df: DataFrame, path: str, key: str, columns: Sequence[str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None, slices: int = 1,
) -> DataFrame:
    """Append one row per key the output does not hold yet; returns the output as it is stored.

    The input is computed once: rows with new keys go to a staging table in the shared folder, in ``slices`` by
    the key's hash. ``transform``, such as a model's scoring, then runs slice after slice on what is staged, and each
    slice is committed by a line in the output's log when it is written. So a run that breaks off loses the
    slice at work, nobody sees half of one, and a repeated call goes on from there. Of rows with the same key the
    smallest is taken; columns without an order are compared as JSON text.
    """
    spark = df.sparkSession
    keep = list(columns or df.columns)
    out = transform(df).select(*keep) if transform else df.select(*keep)
    key_type = [f for f in df.schema.fields if f.name == key]
    done = existing_or_none(spark, path, T.StructType(key_type))
    todo = df if done is None else not_done(df, done, key)
    rest = [c for c in df.columns if c != key]
    if rest:
        one = F.min_by(F.struct(*rest), F.struct(*[_ordering(df.schema, c) for c in rest])).alias("_row")
        todo = todo.groupBy(key).agg(one).select(*[F.col(c) if c == key else F.col("_row")[c].alias(c) for c in df.columns])
    else:
        todo = todo.distinct()
    staged = shared_folder(spark)
    number = F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")
    todo.withColumn(STAGED_SLICE, number).hint("rebalance", STAGED_SLICE).write.partitionBy(STAGED_SLICE).parquet(staged)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(STAGED_SLICE, T.IntegerType())])).parquet(staged)
    run = uuid.uuid4().hex
    for i in range(slices):
        part = rows.where(F.col(STAGED_SLICE) == i).drop(STAGED_SLICE)
        name = f"{run}-{i}"
        write_jsonl((transform(part) if transform else part).select(*keep), f"{path}/{SLICES}/{name}")
        spark.createDataFrame([(name,)], "slice string").coalesce(1).write.mode("append").json(f"{path}/{COMMITS}")
    return read_appended(spark, path, out.schema)


def read_appended(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All rows that ``append_new`` has committed to an output."""
    found = existing_or_none(spark, path, schema)
    if found is None:
        raise FileNotFoundError(f"{path} holds no output")
    return found

