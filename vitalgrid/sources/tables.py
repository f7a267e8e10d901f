"""Table readers and writers. Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vitalgrid.functions.scalars import nan_to_null
from vitalgrid.sources.records import csv_records

#: What Spark calls an absent or damaged file.
UNREADABLE = ("PATH_NOT_FOUND", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA")


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, kind: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a source table; ``kind`` is parquet, csv, orc or jdbc.

    NaN becomes NULL: Spark would rank a NaN above every number.
    """
    reader = spark.read.options(**dict(options or {}))
    if kind == "jdbc":
        df = reader.format("jdbc").load()
    elif kind == "csv":
        return read_csv(spark, path, schema)
    else:
        df = (reader.schema(schema) if schema else reader).format(kind).load(path)
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df


#: The usual dialect: quotes are doubled inside quotes.
DIALECT = {"quote": '"', "escape": '"'}


#: A null mark that no file holds: with an empty one a quoted empty text would be NULL as well.
CELLS = {"nullValue": "\x01", "emptyValue": ""}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] | None = None,
    multiline: bool = False, mode: str = "FAILFAST",
) -> DataFrame:
    """Read CSV with a header.

    ``multiline`` allows line breaks inside quotes (``records.py``); files are read by as many tasks without it.
    Nothing between two commas is NULL, two quotes are an empty text. A row that does not fit the schema is an error unless ``mode`` says otherwise. For that
    all columns are parsed, and the wanted ones converted; with PERMISSIVE or DROPMALFORMED
    only the wanted ones are parsed where no line breaks are expected.
    """
    if multiline:
        df = _read_records(spark, path, schema, mode)
    else:
        reader = spark.read.options(**DIALECT, **CELLS, columnPruning=str(mode != "FAILFAST").lower())
        df = reader.csv(path, schema=schema, header=True, enforceSchema=False, mode=mode)
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    df = df.withColumns({c: nan_to_null(F.col(f"`{c}`")) for c in floats}) if floats else df
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def _read_records(spark: SparkSession, path: str, schema: T.StructType | str, mode: str) -> DataFrame:
    """Records parsed one by one; a head that does not name the schema's columns is an error."""
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    records = csv_records(spark, path)
    names = T.StructType([T.StructField(f"n{i}", T.StringType()) for i in range(len(wanted))])
    head = F.from_csv("record", names.simpleString()[7:-1].replace(":", " "), DIALECT)
    fits = [F.lower(F.trim(head[f"n{i}"])).eqNullSafe(f.name.lower()) for i, f in enumerate(wanted)]
    named = F.assert_true(reduce(and_, fits), F.concat(F.lit("unexpected CSV header: "), F.col("record")))
    rows = records.where(F.when(F.col("is_head"), named.isNotNull()).otherwise(F.lit(True)))
    broken = "_broken"
    permissive = mode != "FAILFAST"
    full = T.StructType([*wanted.fields, T.StructField(broken, T.StringType())]) if permissive else wanted
    options = {**DIALECT, **CELLS, "mode": "PERMISSIVE" if permissive else "FAILFAST", "columnNameOfCorruptRecord": broken}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full)
    rows = rows.select(F.from_csv("record", ddl, options).alias("_r"))
    if mode == "DROPMALFORMED":
        rows = rows.where(F.col("_r")[broken].isNull())
    return rows.select(*[F.col("_r")[f.name].alias(f.name) for f in wanted])


def csv_header(spark: SparkSession, path: str, drop: Sequence[str] = ()) -> list[str]:
    """Column names of a CSV file, without its rows."""
    return [c for c in spark.read.options(**DIALECT).csv(path, header=True).columns if c not in set(drop)]


def as_text_floats(df: DataFrame, float_fmt: str = "%.6f") -> DataFrame:
    """Floating columns as text in a fixed format; NULL stays NULL."""

    def shown(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return F.when(c.isNotNull(), F.format_string(float_fmt, c)).alias(f.name)
        return c

    return df.select(*[shown(f) for f in df.schema])


def write_csv(df: DataFrame, path: str, float_fmt: str | None = "%.6f", mode: str = "errorifexists") -> None:
    """Write CSV with a header, floats in a fixed format."""
    out = as_text_floats(df, float_fmt) if float_fmt else df
    blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    out.write.mode(mode).options(**DIALECT, **blanks).csv(path, header=True)


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Drop and recreate a result table as Parquet."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def sorted_export(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in global order by range partitions: parts are sorted and follow each other."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def save_params(df: DataFrame, path: str) -> None:
    """Store fitted values as (name, value) rows."""
    df.select(F.col("name").cast("string"), F.col("value").cast("double")).write.mode("overwrite").parquet(path)


def load_param(spark: SparkSession, path: str, name: str, default: float) -> float:
    """A stored fitted value; the default when it is absent or cannot be read."""
    try:
        stored = spark.read.schema("name string, value double").parquet(path)
        rows = stored.where(F.col("name") == name).select("value").limit(1).collect()
    except (PySparkException, Py4JJavaError) as e:  # a task's failure arrives unconverted
        if not any(f"[{c}" in str(e) for c in UNREADABLE):
            raise
        return default
    return default if not rows or rows[0][0] is None else float(rows[0][0])
