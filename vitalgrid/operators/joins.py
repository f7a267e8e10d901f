"""Joins and small relational helpers.

In every join here the row-level table is on the left and the other side has
one row per key, so the adaptive skew join can split a hot key. No side is
broadcast by hint: Spark broadcasts one only below its size threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from vitalgrid.operators.ordered import ordinal


def to_wide_names(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Choose and rename columns; the mapping gives order and new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def drop_features(df: DataFrame, prefix: str, n: int) -> DataFrame:
    """Drop a numbered family of columns, prefix0 .. prefix(n-1)."""
    return df.drop(*[f"{prefix}{i}" for i in range(n)])


def only_first_record(df: DataFrame, record: str, cols: Sequence[str]) -> DataFrame:
    """Keep the columns on record 1, NULL elsewhere."""
    return df.withColumns({c: F.when(F.col(record) == 1, F.col(c)) for c in cols})


def filter_group_size(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows of groups with at least ``n`` rows."""
    keys = list(keys)
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n).select(*keys)
    return df.join(big, keys, "left_semi")


def code_version(df: DataFrame, col: str, version: int | None) -> DataFrame:
    """Rows of one coding version; all when no version is asked for."""
    return df if version is None else df.where(F.col(col) == version)


def join_dictionary(codes: DataFrame, dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    return codes.join(dictionary, list(keys), "inner")


def assemble(grid: DataFrame, *visit_tables: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join any number of visit-level tables on the same keys."""
    out = grid
    for table in visit_tables:
        out = out.join(table, list(keys), "left")
    return out


def attach(df: DataFrame, feats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join per-key features to rows."""
    return df.join(feats, list(keys), "left")


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the id table."""
    return df.join(ids.select(key), key, "left_semi")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in an earlier output."""
    return df.join(done.select(key), key, "left_anti")


def split_frames(df: DataFrame, split: str, names: Sequence[str] = ("train", "val", "test")) -> dict[str, DataFrame]:
    """One frame per split; together they are the whole input."""
    return {n: df.where(F.col(split) == n).drop(split) for n in names}


def join_answers(context: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Contexts with their answers; a repeated answer repeats the row."""
    return answers.join(context, key, "inner")


def _unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; a repeated key is an error when the plan runs."""
    rest = [c for c in df.columns if c not in set(keys)]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*rest)).alias("_row"))
    row = F.when(F.col("_n") == 1, F.col("_row")).otherwise(
        F.raise_error(F.concat(F.lit("key is not unique: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])))
    )
    return one.select(*keys, row.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def pair_scores(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two score tables side by side, one row per key on each side."""
    return _unique(a, [key]).join(_unique(b, [key]), key, "inner")


def rank_align(
    left: DataFrame, right: DataFrame, key: str, order_left: Sequence[str] | None, order_right: Sequence[str] | None,
    rank: str = "visit_rank",
) -> DataFrame:
    """Left join two per-visit tables by the row's rank inside the key.

    A row number is unique by construction. A side with ``None`` for its order
    brings its own ``rank`` column; a repeated (key, rank) there is an error.
    """
    sides = []
    for df, order in ((left, order_left), (right, order_right)):
        sides.append(_unique(df, [key, rank]) if order is None else ordinal(df, [key], order, out=rank))
    return sides[0].join(sides[1], [key, rank], "left")


def patient_label(df: DataFrame, key: str, label: str, out: str | None = None) -> DataFrame:
    """Replace (or add) the label by its maximum over the key."""
    best = df.groupBy(key).agg(F.max(label).alias("_best"))
    joined = df.join(best, key, "left")
    return joined.withColumn(out or label, F.col("_best")).drop("_best")


def visit_label(df: DataFrame, keys: Sequence[str], labels: Mapping[str, str]) -> DataFrame:
    """One row per visit; each label by ``max`` or ``avg`` over its records."""
    how = {"max": F.max, "avg": F.avg}
    return df.groupBy(*keys).agg(*[how[h](c).alias(c) for c, h in labels.items()])


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def union_parts(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def expand(df: DataFrame, array: str, prefix: str, n: int) -> DataFrame:
    """Array to columns prefix0 .. prefix(n-1)."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, *[F.get(F.col(array), F.lit(i)).alias(f"{prefix}{i}") for i in range(n)])
