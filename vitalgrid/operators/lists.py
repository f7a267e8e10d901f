"""Joined text lists per group, and the most common entries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from vitalgrid.functions.texts import split_trim, zip_lists
from vitalgrid.operators.ordered import add_hot_chunks, ordinal
from vitalgrid.operators.sizes import GroupSizes, group_sizes

PART = 2048
#: A task joins this many entries of one group; larger groups are joined in parts.
LIST_ROWS = 200_000
#: What one cell can hold, with room for the engine's own copies.
CELL_BYTES = 1 << 30


def _join_groups(df: DataFrame, group: Sequence[str], cols: Mapping[str, str], order: Sequence[str], sep: str) -> DataFrame:
    """Join each column's values per group in order; NULLs left out, NULL for no value.

    Rows go to their group by ``repartition``: a list cannot be combined before
    the shuffle, and moving rows is cheaper than moving half-built lists.
    """
    entry = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c).alias(n) for n, c in cols.items()])
    packed = df.repartition(*group).groupBy(*group).agg(
        F.sort_array(F.collect_list(entry)).alias("_all"), *[F.count(c).alias(f"_n_{n}") for n, c in cols.items()]
    )
    lists = [F.when(F.col(f"_n_{n}") > 0, F.array_join(F.col("_all")[n], sep)).alias(n) for n in cols]
    return packed.select(*group, *lists)


def list_parts(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], order: Sequence[str], sep: str = ";",
    part_size: int = PART,
) -> DataFrame:
    """Joined lists in parts of at most ``part_size`` entries: (keys, part, lists).

    Duplicates stay, NULLs are skipped, the order is the given one, which must
    be total. A large group is numbered and joined by many tasks.
    """
    numbered = ordinal(df, keys, list(order), out="_at")
    numbered = numbered.withColumn("part", F.floor((F.col("_at") - 1) / F.lit(part_size)).cast("long"))
    return _join_groups(numbered, [*keys, "part"], cols, ["_at"], sep)


def visit_lists(
    df: DataFrame, keys: Sequence[str], cols: Mapping[str, str], order: Sequence[str], sep: str = ";",
    part_rows: int = LIST_ROWS, cell_bytes: int = CELL_BYTES, sizes: GroupSizes | None = None,
) -> DataFrame:
    """One joined list per group and column; NULL when it has no value.

    If no group has more than ``part_rows`` entries, groups are joined in one step. Otherwise
    the rows of larger groups are range-partitioned by their order, so that clustered or common
    starts are cut as well, each part is joined by a task of its own, and only finished parts
    of a group meet: the last step holds no more than the cell it writes. A list of
    more than ``cell_bytes`` bytes is an error before anything is joined: use ``list_parts``.

    ``sizes`` is that of a table whose groups are at least as large; entries are then taken to be short unless it says
    otherwise, and bytes are measured only where it has a group of more than ``part_rows`` entries or ``cell_bytes`` bytes.
    """
    order = list(order)
    df = df.select(*dict.fromkeys([*keys, *order, *cols.values()]))
    texts = sorted(set(cols.values()))
    if sizes is None or not sizes.bounds(keys) or sizes.rows > part_rows or sizes.bytes > cell_bytes:
        sizes = group_sizes(df, keys, texts)
    if sizes.bytes > cell_bytes:
        raise ValueError(f"a joined list of {sizes.bytes} bytes does not fit one cell: use list_parts, which gives it in parts")
    if sizes.rows <= part_rows:
        return _join_groups(df, list(keys), cols, order, sep)
    rows = add_hot_chunks(df, keys, order, None, part_rows, sizes=sizes)
    parts = _join_groups(rows, [*keys, "_chunk"], cols, order, sep)
    return _join_groups(parts, list(keys), {n: n for n in cols}, ["_chunk"], sep)


def top_pairs(df: DataFrame, titles: str, codes: str, k: int = 10, sep: str = ";") -> DataFrame:
    """Most common (title, code) pairs of two joined lists.

    Lists are cut to the shorter one; ties are ordered by name.
    """
    both = df.where(F.col(titles).isNotNull() & F.col(codes).isNotNull())
    pair = both.select(F.explode(zip_lists(F.col(titles), F.col(codes), sep)).alias("p"))
    counted = pair.groupBy(F.col("p.a").alias("title"), F.col("p.b").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "title", "code").limit(k)


def top_items(df: DataFrame, items: str, k: int = 10, sep: str = ";") -> DataFrame:
    """Most common entries of a joined list; ties are ordered by name."""
    item = df.where(F.col(items).isNotNull()).select(F.explode(split_trim(F.col(items), sep)).alias("item"))
    return item.groupBy("item").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "item").limit(k)
