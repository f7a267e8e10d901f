"""CSV records that may hold line breaks, read by many tasks.

A line begins a record where an even number of quotes stands before it in its
file. The text reader cuts files into blocks and blocks into lines. A first pass counts the
quotes of each block (summed before the shuffle); running sums over the blocks of a file tell whether a block
begins inside quotes. A second pass does the same for the lines of each block. Lines
that are whole records, nearly all as a rule, go straight to the parser. The others
are put together inside their block, and only what is open at a block's border,
two pieces per block at most, meets the next block's beginning.

A block is what the session calls a partition of files (``spark.sql.files.maxPartitionBytes``), so a
file is read by as many tasks as a plain one. Quotes must be doubled inside quotes and
stand nowhere else than around a field; a file that ends inside quotes is an error, and quotes strewn over
several lines give records of a wrong width, which ``FAILFAST`` reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_BLOCK = ["_file", "_block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: (_file, _block, _line, value, _quotes)."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.withColumn("_quotes", quotes.cast("long"))


def _block_starts(lines: DataFrame) -> DataFrame:
    """Whether each block begins and ends inside quotes: one row per block."""
    blocks = lines.groupBy(*_BLOCK).agg(F.sum("_quotes").alias("_n"))
    in_file = Window.partitionBy("_file").orderBy("_block")
    upto = F.sum("_n").over(in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    is_last = F.lead("_block").over(in_file).isNull()
    blocks = blocks.withColumns({"_upto": upto, "_is_last": is_last})
    message = F.concat(F.col("_file"), F.lit(" ends inside quotes"))
    closed = F.when(F.col("_is_last") & (F.col("_upto") % 2 == 1), F.raise_error(message)).otherwise(F.col("_upto") % 2)
    return blocks.select(*_BLOCK, ((F.col("_upto") - F.col("_n")) % 2).alias("_opens"), closed.cast("long").alias("_closes"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, is_head): the records of all files as text; is_head for the first of each file."""
    lines = _lines(spark, path)
    starts = _block_starts(lines).withColumnsRenamed({c: f"{c}_" for c in _BLOCK})
    on = [F.col(c) == F.col(f"{c}_") for c in _BLOCK]
    rows = lines.join(starts, on).drop(*[f"{c}_" for c in _BLOCK])

    inside = Window.partitionBy(*_BLOCK).orderBy("_line")
    before = F.coalesce(F.sum("_quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_begins", (F.col("_opens") + before) % 2 == 0)
    number = F.sum(F.col("_begins").cast("long")).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.lead("_begins").over(inside)
    rows = rows.withColumns({
        "_record": number,
        "_whole": F.col("_begins") & F.coalesce(ahead, F.col("_closes") == 0),
        "_open": ahead.isNull() & (F.col("_closes") == 1),
        "_head": (F.col("_block") == 0) & (F.row_number().over(inside) == 1),
    })
    whole = rows.where("_whole").select(F.col("value").alias("record"), F.col("_head").alias("is_head"))

    def joined(df: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
        parts = F.sort_array(F.collect_list(F.struct(order, text)))[text]
        return df.groupBy(*keys).agg(
            F.array_join(parts, "\n").alias("record"), F.max("_head").alias("is_head"), F.max("_open").alias("_open")
        )

    pieces = joined(rows.where("not _whole"), [*_BLOCK, "_record"], "_line", "value")
    # A piece is open where it has no beginning in its block, or its block ends inside it.
    border = (F.col("_record") == 0) | F.col("_open")
    inner = pieces.where(~border).select("record", "is_head")
    at = Window.partitionBy("_file").orderBy("_block", "_record").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_ones = pieces.where(border).withColumn("_owner", F.sum((F.col("_record") > 0).cast("long")).over(at))
    open_ones = open_ones.withColumnsRenamed({"record": "_text", "is_head": "_head"})
    open_ones = open_ones.withColumn("_place", F.struct("_block", "_record"))
    crossing = joined(open_ones, ["_file", "_owner"], "_place", "_text").select("record", "is_head")
    records = whole.unionByName(inner).unionByName(crossing)
    # Lines may end in a carriage return; an empty line is no record.
    records = records.withColumn("record", F.regexp_replace("record", r"\r$", ""))
    return records.where("record <> ''")
