"""Repeatable sampling, splitting and pseudonyms.

All of them rank ids by ``md5(seed-id)``: exact sizes, no repeats, the same rows
for the same seed whatever the partitioning. The rank is built in two levels,
inside buckets of equal hash prefix and then over the buckets, so no task sorts
all ids and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vitalgrid.session import materialize

PREFIX = 3  # hexadecimal digits: 4,096 buckets, evenly filled by the hash


def hash_key(id_col: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), id_col.cast("string")))


def hash_rank(
    ids: DataFrame, id_col: str, seed: int, by: Sequence[str] = (), out: str = "rank", size: str | None = None
) -> DataFrame:
    """Rank unique ids by hash, from 1, inside each group of ``by``."""
    by = list(by)
    rows = ids.withColumn("_h", hash_key(F.col(id_col), seed)).withColumn("_b", F.substring("_h", 1, PREFIX))
    counts = rows.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    # At most 4,096 rows per group of ``by``.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("_size")
    )
    local = F.row_number().over(Window.partitionBy(*by, "_b").orderBy("_h", id_col))
    joined = rows.withColumn("_local", local).join(counts, by + ["_b"], "inner")
    cols = [(F.col("_local") + F.col("_before")).cast("long").alias(out)]
    if size:
        cols.append(F.col("_size").cast("long").alias(size))
    return joined.select(*ids.columns, *cols)


def class_sizes(ids: DataFrame, label: str) -> DataFrame:
    """One row: how many positive and negative ids there are."""
    return ids.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def stratified_sample(
    ids: DataFrame, id_col: str, label: str, total: int, share: float, seed: int, backfill: bool = False
) -> DataFrame:
    """Exact number of ids per class without replacement, limited by what there is.

    ``ids`` has one row per id. With ``backfill`` a short class is made up from
    the other one, again limited by what is left. Returns (id, label).
    """
    want_pos = int(total * share)
    want_neg = total - want_pos
    sizes = class_sizes(ids, label)
    pos, neg = F.col("pos"), F.col("neg")
    take_pos, take_neg = F.least(F.lit(want_pos), pos), F.least(F.lit(want_neg), neg)
    if backfill:
        short_pos, short_neg = F.lit(want_pos) - take_pos, F.lit(want_neg) - take_neg
        take_pos, take_neg = (
            F.least(pos, take_pos + short_neg),
            F.least(neg, take_neg + short_pos),
        )
    targets = sizes.select(F.struct(take_pos.alias("pos"), take_neg.alias("neg")).alias("t")).scalar()
    ranked = hash_rank(ids.select(id_col, label).where(F.col(label).isin(0, 1)), id_col, seed, by=[label])
    limit = F.when(F.col(label) == 1, targets["pos"]).otherwise(targets["neg"])
    return ranked.where(F.col("rank") <= limit).select(id_col, label)


def sample_exact(ids: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` ids; fewer available is an error when the plan runs."""
    ranked = hash_rank(ids.select(id_col).distinct(), id_col, seed, size="_size")
    enough = F.when(F.col("_size") >= n, F.col("rank") <= n).otherwise(
        F.raise_error(F.concat(F.lit(f"fewer ids than the requested {n}: "), F.col("_size").cast("string"))).cast("boolean")
    )
    return ranked.where(enough).select(id_col)


def split_labels(ids: DataFrame, id_col: str, ratios: tuple[float, float], seed: int, out: str = "split") -> DataFrame:
    """Each id with train, val or test: floor(n*r1), floor(n*r2) and the rest."""
    ranked = hash_rank(ids.select(id_col).distinct(), id_col, seed, out="_r", size="_n")
    n_train = F.floor(F.col("_n") * F.lit(float(ratios[0])))
    n_val = F.floor(F.col("_n") * F.lit(float(ratios[1])))
    name = (
        F.when(F.col("_r") <= n_train, F.lit("train"))
        .when(F.col("_r") <= n_train + n_val, F.lit("val"))
        .otherwise(F.lit("test"))
    )
    return ranked.select(id_col, name.alias(out))


def split_by_entity(df: DataFrame, id_col: str, ratios: tuple[float, float], seed: int, out: str = "split") -> DataFrame:
    """All rows of an id go to the same split."""
    return df.join(split_labels(df, id_col, ratios, seed, out), id_col, "inner")


def pseudonym_map(ids: DataFrame, id_col: str, seed: int, offset: int = 10_000, out: str = "new_id") -> DataFrame:
    """A permutation of 1..n plus an offset, one row per id."""
    ranked = hash_rank(ids.select(id_col).distinct(), id_col, seed, out="_r")
    return ranked.select(id_col, (F.col("_r") + offset).alias(out))


def extend_pseudonyms(
    spark: SparkSession, path: str, ids: DataFrame, id_col: str, seed: int, offset: int = 10_000, out: str = "new_id"
) -> DataFrame:
    """The pseudonym map stored at ``path``, extended by the ids it lacks.

    Old ids keep their pseudonyms whatever comes later; new ones go on behind the largest number in use, in the
    order of their hash rank (in two levels, as in ``pseudonym_map``). One writer at a time; after a run that broke off
    the next one numbers what is still missing.
    """
    wanted = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    old = stored_pseudonyms(spark, path, id_col, out)
    last = None if old is None else old.agg(F.max(out)).first()[0]
    fresh = wanted if old is None else wanted.join(old.select(id_col), id_col, "left_anti")
    # Stored before it is appended, so that the map is not read and written in one job.
    fresh = materialize(pseudonym_map(fresh, id_col, seed, offset if last is None else last, out))
    if old is None or not fresh.isEmpty():
        fresh.write.mode("append").parquet(path)
    return stored_pseudonyms(spark, path, id_col, out)


def stored_pseudonyms(spark: SparkSession, path: str, id_col: str, out: str = "new_id") -> DataFrame | None:
    """The map at ``path``, None where there is none yet; two ids with one number, or an id with two, are an error."""
    try:
        found = spark.read.parquet(path).select(id_col, out)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    n, n_ids, n_numbers = found.agg(F.count(F.lit(1)), F.count_distinct(id_col), F.count_distinct(out)).first()
    if not n == n_ids == n_numbers:
        raise ValueError(f"{path}: {n} rows for {n_ids} ids and {n_numbers} pseudonyms; two writers at once?")
    return found


def pseudonymize(df: DataFrame, id_col: str, seed: int, offset: int = 10_000, path: str | None = None) -> DataFrame:
    """Replace an id by its pseudonym; with ``path`` by that of the map stored there, which is extended first."""
    if path is None:
        ids = pseudonym_map(df, id_col, seed, offset, "_new")
    else:
        ids = extend_pseudonyms(df.sparkSession, path, df, id_col, seed, offset).withColumnRenamed("new_id", "_new")
    return df.join(ids, id_col, "inner").withColumn(id_col, F.col("_new")).select(*df.columns)
