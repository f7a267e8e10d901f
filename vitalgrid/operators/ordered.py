"""Ordered per-group operators that never put a whole large group into one task.

A patient or visit may own a large share of all rows, so a window over a group
is safe only for groups of known size. Every operator here asks for the largest group's
size first (``sizes.py``: counted once per table and keys, or handed in as ``sizes``). If no group has more than ``hot_rows`` rows, the plain window is all
there is. Otherwise the rows of the hot groups, and only they, are range-partitioned by keys and
order columns; the range bounds follow the rows themselves, so clustered times,
texts with a common start, sparse ids and ties on the leading column are cut into
parts of about half of ``hot_rows``. A part's number is the rows' chunk. The work is done inside
(group, chunk), and a summary with one row per hot (group, chunk) carries values
between chunks. The summary is combined before its shuffle and joined back on
(group, chunk) by a merge join, as it has no size bound that the planner can see.

Chunks are stored with their rows in the shared folder before they are used:
retries and lost executors cannot change them. Rows that are equal in all order
columns are never separated. With ``hot_rows`` None every group is cut by fixed strides of the
leading order column instead, for values whose range is known.

Group keys must not be NULL; the order columns must be a total order where the
result depends on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from vitalgrid.functions.timing import US_PER_DAY, micros
from vitalgrid.operators.sizes import GroupSizes, group_sizes
from vitalgrid.session import materialize

TIME_STRIDE = 7 * US_PER_DAY
COUNT_STRIDE = 4096

_BEFORE_ALL = -(2**62)
_CHUNK = "_chunk"
_HOT = "_hot"
# A task sorts this many rows without trouble.
HOT_ROWS = 1_000_000


def _axis(df: DataFrame, name: str) -> tuple[Column, float]:
    """Numeric form of an order column and its default stride."""
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return micros(c), TIME_STRIDE
    if isinstance(kind, T.NumericType):
        return c, COUNT_STRIDE
    if isinstance(kind, T.StringType):
        # Code points of the first three characters: order-preserving.
        points = [F.ascii(F.substring(c, i, 1)).cast("long") for i in (1, 2, 3)]
        return F.shiftleft(points[0], 42) + F.shiftleft(points[1], 21) + points[2], 1
    raise TypeError(f"leading order column {name} must be a time, a number or a text, not {kind.simpleString()}")


def _chunk(axis: Column, stride: float) -> Column:
    step = F.lit(int(stride)) if float(stride).is_integer() else F.lit(float(stride))
    # NULL sorts first, as it does in a window.
    return F.coalesce(F.floor(axis / step).cast("long"), F.lit(_BEFORE_ALL))


def add_range_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = _CHUNK) -> DataFrame:
    """Cut all rows by the order of (keys, order columns) into parts of about equal size, whatever the values are.

    The bounds come from the rows themselves. Stored, as a retry could sample other bounds.
    """
    parts = df.repartitionByRange(*keys, *order).withColumn(name, F.spark_partition_id().cast("long") + 1)
    return materialize(parts).withColumn(_HOT, F.lit(True))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and their sizes; at most rows / ``hot_rows`` of them."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.where(F.col("_n") > hot_rows)


def add_hot_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], strides: Sequence[float] | None, hot_rows: int | None,
    names: Sequence[str] = (_CHUNK,), sizes: GroupSizes | None = None,
) -> DataFrame:
    """Add chunk numbers: 0 for a group of usual size, from 1 on for a hot one.

    With ``hot_rows`` None every group is cut by strides, a level per name. ``sizes`` is that of a table whose
    groups are at least as large, by these keys or fewer of them.
    """
    if hot_rows is None:
        axis, default = _axis(df, order[0])
        chunks = {n: _chunk(axis, s) for n, s in zip(names, strides or [default])}
        return df.withColumns({**chunks, _HOT: F.lit(True)})
    plain = {n: F.lit(0).cast("long") for n in names}
    if not (sizes is not None and sizes.bounds(keys) and sizes.rows <= hot_rows) and keys:
        sizes = group_sizes(df, keys)
    if sizes is not None and sizes.rows <= hot_rows:
        return df.withColumns({**plain, _HOT: F.lit(False)})
    hot = materialize(hot_keys(df, keys, hot_rows))
    total = hot.agg(F.sum("_n")).first()[0]
    parts = 2 * -(-total // hot_rows)
    # Rows on the left: a hot key may be most of them, and the list has one row per key.
    warm = df.join(hot.select(*keys), list(keys), "left_semi").select(*df.columns)
    warm = warm.repartitionByRange(parts, *keys, *order).withColumn(names[0], F.spark_partition_id().cast("long") + 1)
    warm = materialize(warm).withColumns({n: plain[n] for n in names[1:]} | {_HOT: F.lit(True)})
    cold = df.join(hot.select(*keys), list(keys), "left_anti").select(*df.columns)
    return cold.withColumns({**plain, _HOT: F.lit(False)}).unionByName(warm)


def _unbounded_before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Column],
    strides: Sequence[float] | None = None,
    totals: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Add, per measure, the sum over all earlier rows of the group (0 for the first).

    Without keys, or with ``hot_rows`` None, all rows are cut: by ``strides`` from coarse to fine, where each level
    bounds the summary window of the level above it, or, without strides, into parts of about equal size. For a name in ``totals`` the group total is added as
    ``<name>_total``.
    """
    keys, order = list(keys), list(order)
    # The stride levels are for cutting every group; hot groups are cut by their rows, in one level.
    cut_all = hot_rows is None or not keys
    levels = list(strides or [1]) if cut_all else [1]
    chunk_cols = [f"{_CHUNK}{i}" for i in range(len(levels))]
    value = {f"_m_{n}": m for n, m in measures.items()}
    if cut_all and strides is None:
        rows = add_range_chunks(df.withColumns(value), keys, order, chunk_cols[0])
    else:
        rows = add_hot_chunks(df.withColumns(value), keys, order, levels, None if cut_all else hot_rows, chunk_cols, sizes)

    summary = rows.where(_HOT).groupBy(*keys, *chunk_cols).agg(*[F.sum(v).alias(v) for v in value])
    carry = None
    for depth in range(1, len(levels) + 1):
        at = keys + chunk_cols[:depth]
        table = summary if depth == len(levels) else summary.groupBy(*at).agg(*[F.sum(v).alias(v) for v in value])
        parent = Window.partitionBy(*at[:-1]) if at[:-1] else Window.partitionBy(F.lit(0))
        before = _unbounded_before(parent.orderBy(at[-1]))
        cols = {f"_b{v}": F.coalesce(F.sum(v).over(before), F.lit(0)) for v in value}
        if depth == 1:
            cols |= {f"_t_m_{n}": F.sum(f"_m_{n}").over(parent) for n in totals}
        table = table.withColumns(cols).drop(*value)
        if carry is not None:
            renamed = carry.select(
                *[c for c in carry.columns if not c.startswith("_b_m_")],
                *[F.col(f"_b{v}").alias(f"_up{v}") for v in value],
            )
            table = table.join(renamed, at[:-1], "left")
            table = table.withColumns({f"_b{v}": F.col(f"_b{v}") + F.col(f"_up{v}") for v in value}).drop(
                *[f"_up{v}" for v in value]
            )
        carry = table

    chunk = Window.partitionBy(*keys, *chunk_cols)
    inside = _unbounded_before(chunk.orderBy(*order))
    local = {f"_l{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in value}
    local |= {f"_w_m_{n}": F.sum(f"_m_{n}").over(chunk) for n in totals}
    local = rows.withColumns(local)
    out = local.join(carry.hint("merge"), keys + chunk_cols, "left")
    result = {n: F.col(f"_l_m_{n}") + F.coalesce(F.col(f"_b_m_{n}"), F.lit(0)) for n in measures}
    result |= {f"{n}_total": F.coalesce(F.col(f"_t_m_{n}"), F.col(f"_w_m_{n}")) for n in totals}
    return out.select(*df.columns, *[c.alias(n) for n, c in result.items()])


def ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    kind: str = "row_number",
    out: str = "ordinal",
    size: str | None = None,
    stride: float | None = None,
    hot_rows: int | None = HOT_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Position of each row in its group, from 1.

    ``row_number`` counts rows; ``dense_rank`` gives equal order values the
    same number. ``size`` adds the number of positions in the group.
    """
    keys, order = list(keys), list(order)
    if kind not in ("row_number", "dense_rank"):
        raise ValueError(f"unknown ordinal kind {kind!r}")
    rows = add_hot_chunks(df, keys, order, [stride] if stride else None, hot_rows, sizes=sizes)
    chunk = Window.partitionBy(*keys, _CHUNK)
    inside = chunk.orderBy(*order)
    if kind == "row_number":
        local, n_local = F.row_number().over(inside), F.count(F.lit(1))
    else:
        local, n_local = F.dense_rank().over(inside), F.count_distinct(F.struct(*order))
    summary = rows.where(_HOT).groupBy(*keys, _CHUNK).agg(n_local.alias("_n"))
    per_key = Window.partitionBy(*keys)
    cols = {"_before": F.sum("_n").over(_unbounded_before(per_key.orderBy(_CHUNK)))}
    if size:
        cols["_size"] = F.sum("_n").over(per_key)
    summary = summary.withColumns(cols).drop("_n")
    numbered = rows.withColumn("_local", local)
    if size:
        # The last number of the chunk is its number of positions.
        numbered = numbered.withColumn("_inside", F.max("_local").over(chunk))
    joined = numbered.join(summary.hint("merge"), keys + [_CHUNK], "left")
    picked = [(F.col("_local") + F.coalesce(F.col("_before"), F.lit(0))).cast("long").alias(out)]
    if size:
        picked.append(F.coalesce(F.col("_size"), F.col("_inside")).cast("long").alias(size))
    return joined.select(*df.columns, *picked)


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Mapping[str, str],
    side: str,
    stride: float | None = None,
    hot_rows: int | None = HOT_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Values of the previous (``side="lag"``) or next (``"lead"``) row of the group.

    ``cols`` maps new names to existing columns. Only the first (last) row of a
    chunk of a hot group looks at the summary.
    """
    if side not in ("lag", "lead"):
        raise ValueError(f"unknown side {side!r}")
    keys, order = list(keys), list(order)
    rows = add_hot_chunks(df, keys, order, [stride] if stride else None, hot_rows, sizes=sizes)
    shift = F.lag if side == "lag" else F.lead
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    packed = F.struct(*[F.col(c).alias(n) for n, c in cols.items()])
    edge_of = F.max_by if side == "lag" else F.min_by
    summary = (
        rows.where(_HOT)
        .groupBy(*keys, _CHUNK)
        .agg(edge_of(packed, F.struct(*order)).alias("_edge"))
        .withColumn("_edge", shift("_edge").over(Window.partitionBy(*keys).orderBy(_CHUNK)))
    )
    local = rows.withColumn("_near", shift(packed).over(inside))
    joined = local.join(summary.hint("merge"), keys + [_CHUNK], "left")
    # A struct is NULL only where there is no neighbour inside the chunk.
    near = F.coalesce(F.col("_near"), F.col("_edge"))
    return joined.select(*df.columns, *[near[n].alias(n) for n in cols])


def impute(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    forward: bool = True,
    backward: bool = True,
    bound: int | None = None,
    stride: float | None = None,
    hot_rows: int | None = HOT_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Carry the last value forward, then fill what is left at the start backward.

    After the forward fill only leading rows are NULL, so the backward value is
    the group's first non-null value. All columns share one exchange and one
    sort. With ``bound`` the caller states that no group is longer (it was
    limited before); then sizes need not be counted.
    """
    keys, order, cols = list(keys), list(order), list(cols)

    def fill(group: list[str], carry: bool) -> dict[str, Column]:
        base = Window.partitionBy(*group).orderBy(*order)
        upto = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ahead = base.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = {}
        for c in cols:
            steps = []
            if forward:
                steps.append(F.last(c, ignorenulls=True).over(upto))
                steps += [F.col(f"_last_{c}")] if carry else []
            if backward:
                steps.append(F.first(c, ignorenulls=True).over(whole if forward else ahead))
                steps += [F.col(f"_next_{c}")] if carry else []
            out[c] = F.coalesce(*steps) if steps else F.col(c)
        return out

    if bound is not None:
        return df.withColumns(fill(keys, carry=False)).select(*df.columns)

    rows = add_hot_chunks(df, keys, order, [stride] if stride else None, hot_rows, sizes=sizes)
    at = F.struct(*order)
    edges = []
    for c in cols:
        seen = F.when(F.col(c).isNotNull(), at)
        edges += [F.max_by(c, seen).alias(f"_tail_{c}"), F.min_by(c, seen).alias(f"_head_{c}")]
    summary = rows.where(_HOT).groupBy(*keys, _CHUNK).agg(*edges)
    base = Window.partitionBy(*keys).orderBy(_CHUNK)
    earlier = _unbounded_before(base)
    later = base.rowsBetween(1, Window.unboundedFollowing)
    carried = []
    for c in cols:
        carried.append(F.last(f"_tail_{c}", ignorenulls=True).over(earlier).alias(f"_last_{c}"))
        carried.append(F.first(f"_head_{c}", ignorenulls=True).over(later).alias(f"_next_{c}"))
    summary = summary.select(*keys, _CHUNK, *carried)
    joined = rows.join(summary.hint("merge"), keys + [_CHUNK], "left")
    return joined.withColumns(fill(keys + [_CHUNK], carry=True)).select(*df.columns)


def block_windows(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    longest: int,
    stride: int = COUNT_STRIDE,
) -> tuple[DataFrame, list[str]]:
    """Prepare sliding blocks of up to ``longest`` rows without whole-group windows.

    ``position`` is the 1-based row number in the group. The first rows of a
    chunk are repeated in the chunk before it, so that every block lies inside
    one chunk. Returns the frame, with ``_own`` true for the rows that start a
    block there, and the partition columns.
    """
    if longest > stride:
        raise ValueError(f"block of {longest} rows needs a stride of at least that size")
    zero_based = F.col(position) - 1
    own = F.floor(zero_based / F.lit(stride)).cast("long")
    shared = (own > 0) & (zero_based % stride < longest - 1)
    homes = F.when(shared, F.array(own, own - 1)).otherwise(F.array(own))
    rows = df.withColumn("_home", own).withColumn(_CHUNK, F.explode(homes))
    return rows.withColumn("_own", F.col(_CHUNK) == F.col("_home")).drop("_home"), list(keys) + [_CHUNK]


def block_means(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    cols: Sequence[str],
    length: int,
    stride: int = COUNT_STRIDE,
) -> DataFrame:
    """Mean of each column over every full block of ``length`` rows, NULLs skipped.

    One row per block, named by the position of its first row.
    """
    rows, group = block_windows(df.select(*keys, position, *cols), keys, position, length, stride)
    frame = Window.partitionBy(*group).orderBy(position).rowsBetween(0, length - 1)
    means = {f"mean_{c}": F.avg(c).over(frame) for c in cols}
    out = rows.withColumns({"_rows": F.count(F.lit(1)).over(frame), **means})
    return out.where(F.col("_own") & (F.col("_rows") == length)).select(*keys, position, *means)


def position01(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "pos",
    single: float = 1.0,
    stride: float | None = None,
    hot_rows: int | None = HOT_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """(rank - 1) / (n - 1) inside the group; ``single`` for a group of one row."""
    ranked = ordinal(df, keys, order, out="_rank", size="_n", stride=stride, hot_rows=hot_rows, sizes=sizes)
    pos = F.when(F.col("_n") == 1, F.lit(float(single))).otherwise(
        (F.col("_rank") - 1) / F.nullif(F.col("_n") - 1, F.lit(0))
    )
    return ranked.select(*df.columns, pos.alias(out))


def head_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Spark limits each group to ``n`` rows before the shuffle, so a large group
    arrives small.
    """
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")


def _edge_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in set(keys)]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in set(keys) else F.col("_row")[c].alias(c) for c in df.columns])


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest order value per group, combined before the shuffle."""
    return _edge_row(df, keys, order, F.min_by)


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _edge_row(df, keys, order, F.max_by)


def last_visit_first_row(df: DataFrame, key: str, visit: str, order: Sequence[str]) -> DataFrame:
    """The first row of each patient's last visit."""
    return last_row(first_row(df, [key, visit], order), [key], [visit])


def first_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """First non-null value of each column per group, combined before the shuffle."""
    at = F.struct(*order)
    picks = [F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols]
    return df.groupBy(*keys).agg(*picks)


def truncate_after_last(df: DataFrame, patient: str, visit: str, flag: str) -> DataFrame:
    """Keep each patient's visits up to the last flagged one; all when none is flagged."""
    last = df.where(F.col(flag) == 1).groupBy(patient).agg(F.max(visit).alias("_last"))
    joined = df.join(last, patient, "left")
    return joined.where(F.col(visit) <= F.coalesce(F.col("_last"), F.col(visit))).select(*df.columns)
