"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vitalgrid.session import shared_folder

#: The white space of the contracts, ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: several readers, one computation, whatever executors are lost."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def content_key(text: Column) -> Column:
    """Hash of a text that tells apart the rows of one document id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, chunk: str) -> DataFrame:
    """Number the rows of each group from 0 in the order of (``chunk``, ``order``), in two levels.

    ``chunk`` cuts every group into pieces: a group is numbered piece by piece and
    the pieces get offsets, so that no task needs a whole group.
    """
    from pyspark.sql import Window as W

    sizes = df.groupBy(*group, chunk).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*group, chunk, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(*group, chunk).orderBy(*order)) - 1
    rows = df.withColumn("_inside", inside)
    on = [rows[c].eqNullSafe(starts[c]) for c in [*group, chunk]]
    return rows.join(starts, on).select(
        *[rows[c] for c in df.columns], (F.col("_start") + F.col("_inside")).cast("long").alias(out)
    )


def text_pieces(batch: pa.RecordBatch, column: str, size: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows with about ``size`` bytes of text, without copying.

    Yields (first row, end row, bytes, offsets); a null is an empty text.
    """
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
