"""Long event streams: selection, union, assignment to record windows, pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from vitalgrid.functions.scalars import f_to_c, flag, guard
from vitalgrid.functions.timing import US_PER_DAY, US_PER_HOUR, micros
from vitalgrid.operators.ordered import HOT_ROWS, add_hot_chunks
from vitalgrid.operators.sizes import group_sizes
from vitalgrid.operators.visits import n_windows


def select_items(df: DataFrame, item: str, ids: Sequence, value_cols: Sequence[str]) -> DataFrame:
    """Wanted items with at least one value; both tests reach the Parquet scan."""
    some = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in value_cols))
    return df.where(F.col(item).isin(list(ids)) & some)


def events_union(*parts: DataFrame) -> DataFrame:
    """All parts one after the other; a column a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def events_in_windows(
    visits: DataFrame, events: DataFrame, keys: Sequence[str], admit: str, discharge: str, time: str, hours: int = 12,
    record: str = "record",
) -> DataFrame:
    """Events inside a window of their visit, with the window number.

    A visit becomes one row per calendar day its windows touch, and the join is
    an equality on (keys, day). So the events of a large visit are spread over
    its days, no range has to be compared, and every event meets at most one
    row. The window number is arithmetic; the grid itself is not needed. An
    event with a NULL key matches nothing.
    """
    keys = list(keys)
    last = F.col("_n") * F.lit(hours * US_PER_HOUR) - 1
    day_of = lambda us: F.floor(us / F.lit(float(US_PER_DAY))).cast("long")
    stays = (
        visits.select(*keys, F.col(admit).alias("_admit"), n_windows(F.col(admit), F.col(discharge), hours).alias("_n"))
        .where(F.col("_n") > 0)
        .withColumn("_us", micros(F.col("_admit")))
        .withColumn("_day", F.explode(F.sequence(day_of(F.col("_us")), day_of(F.col("_us") + last))))
        .drop("_admit")
    )
    placed = events.withColumn("_t", micros(F.col(time))).withColumn("_day", day_of(F.col("_t")))
    # Merge join by hint: the planner does not see that ``explode`` made ``stays`` longer.
    joined = placed.join(stays.hint("merge"), keys + ["_day"], "inner")
    number = F.floor((F.col("_t") - F.col("_us")) / F.lit(float(hours * US_PER_HOUR))).cast("long") + 1
    inside = joined.withColumn(record, number).where((F.col("_t") >= F.col("_us")) & (F.col(record) <= F.col("_n")))
    return inside.select(*events.columns, record)


def window_join(
    grid: DataFrame, visits: DataFrame, events: DataFrame, keys: Sequence[str], admit: str, discharge: str, time: str,
    hours: int = 12, record: str = "record", values: Sequence[str] = (), start: str | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every window of ``grid`` with its events; a window without events stays, with NULLs.

    One pass over the union of window starts and events in time order: an event takes the last window that began
    before it in its visit, if that has not ended, and a window is empty if what follows it is no
    event of its own. Both look at neighbours only, so they share one shuffle and one sort of the
    events. Windows of a visit follow one another or leave gaps; they do not overlap. The rows of a visit that is
    too large for one task are range-partitioned by time, and a summary row per part carries the
    open window into the next part and the first row of the next part back.

    ``start`` names the grid's column with the windows' starts; without it they follow from the visits' admission.
    """
    keys = list(keys)
    spare = lambda name: _spare([*grid.columns, *events.columns], name)
    at, kind, window, value, opened, follows = map(spare, ("_us", "_kind", "_window", "_value", "_open", "_next"))
    long = F.lit(hours * US_PER_HOUR)
    packed = F.struct(*[F.col(c) for c in grid.columns])
    if start is not None:
        windows = grid.withColumn(at, micros(F.col(start)))
    else:
        facts = visits.select(*keys, micros(F.col(admit)).alias(at))
        windows = grid.join(facts, keys).withColumn(at, F.col(at) + (F.col(record) - 1) * long)
    windows = windows.select(*keys, F.col(at), F.lit(0).alias(kind), packed.alias(window))
    events = events.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))
    rows = events.select(
        *keys, micros(F.col(time)).alias(at), F.lit(1).alias(kind), F.struct(*[F.col(v) for v in values], F.lit(1).alias("_is")).alias(value)
    )
    both = windows.unionByName(rows, allowMissingColumns=True)
    order = [at, kind]
    # A visit has few windows beside its events.
    cut = add_hot_chunks(both, keys, order, None, hot_rows, sizes=group_sizes(events, keys))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    mine = F.struct(F.col(at), F.col(window).alias("w"))
    seen = F.last(F.when(F.col(kind) == 0, mine), ignorenulls=True)
    ahead = F.struct(F.col(at), F.col(kind))
    cut = cut.withColumns({
        opened: seen.over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)), follows: F.lead(ahead).over(inside),
    })
    # Of hot visits only: the last window begun in each part, and the part's first row.
    parts = cut.where("_hot").groupBy(*keys, "_chunk").agg(
        F.max_by(mine, F.when(F.col(kind) == 0, F.struct(*order))).alias("_last"), F.min(ahead).alias("_first")
    )
    by = Window.partitionBy(*keys).orderBy("_chunk")
    parts = parts.select(
        *keys, "_chunk", F.last("_last", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("_last"),
        F.lead("_first").over(by).alias("_first"),
    )
    cut = cut.join(parts.hint("merge"), [*keys, "_chunk"], "left")
    cut = cut.withColumns({opened: F.coalesce(F.col(opened), F.col("_last")), follows: F.coalesce(F.col(follows), F.col("_first"))})
    filled = (F.col(kind) == 1) & (F.col(at) < F.col(opened)[at] + long)
    own = (F.col(follows)[kind] == 1) & (F.col(follows)[at] < F.col(at) + long)
    empty = (F.col(kind) == 0) & ~F.coalesce(own, F.lit(False))
    kept = cut.where(filled | empty)
    return kept.select(*[F.col(opened)["w"][c].alias(c) for c in grid.columns], *[F.col(value)[v].alias(v) for v in values])


def _spare(taken: Sequence[str], name: str) -> str:
    while name in taken:
        name = "_" + name
    return name


def max_of(item: str, ids: Sequence, value: str) -> Column:
    """Largest value of the items; NULL when none was measured."""
    return F.max(F.when(F.col(item).isin(list(ids)), F.col(value)))


def pivot_items(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Column]) -> DataFrame:
    """Long to wide by one aggregation; each value of ``spec`` is an aggregate such as ``max_of``."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in spec.items()])


def presence(cond: Column) -> Column:
    """Aggregate: 1 when a row of the group meets the condition, else 0."""
    return F.max(flag(cond))


def pivot_flags(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Column]) -> DataFrame:
    """Presence flags per group; 0, not NULL, when absent."""
    return df.groupBy(*keys).agg(*[presence(c).alias(n) for n, c in spec.items()])


def max_converted(
    item: str, value: str, as_is: Sequence, fahrenheit: Sequence, limits: tuple[float, float] | None = None
) -> Column:
    """Largest temperature over Celsius items and converted Fahrenheit items.

    With ``limits`` a value counts only inside them; the test on a Fahrenheit
    value uses the converted number before rounding.
    """
    v = F.col(value)
    plain, converted = v, f_to_c(v)
    if limits is not None:
        lo, hi = limits
        raw = (v - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)
        plain = F.round(guard(v, lo, hi), 2)
        converted = F.when(raw.between(lo, hi), f_to_c(v))
    return F.max(
        F.when(F.col(item).isin(list(as_is)), plain).when(F.col(item).isin(list(fahrenheit)), converted)
    )


def sum_of_max(item: str, value: str, ids: Sequence) -> Column:
    """Sum of the per-item maxima; NULL when one of them is missing."""
    return reduce(add, (max_of(item, [i], value) for i in ids))


def expand_onehot(c: Column, values: Sequence[int], prefix: str) -> dict[str, Column]:
    """One 0/1 column per value."""
    return {f"{prefix}{k}": flag(c == k) for k in values}

