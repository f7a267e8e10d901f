"""How large the groups of a table are: counted once per table and key set, then known to every operator.

A size decides between plans of equal results, never what a result is. So a table
that was rewritten in place since it was counted costs time at worst.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

#: Tables whose sizes are remembered.
REMEMBERED = 256


@dataclass(frozen=True)
class GroupSizes:
    """The largest group of a table by some keys: its rows, and its bytes where texts were measured."""

    keys: frozenset[str]
    rows: int
    bytes: int = 0

    def bounds(self, keys: Sequence[str]) -> bool:
        """Whether groups by ``keys`` can be no larger: more keys make smaller groups."""
        return self.keys <= set(keys)


_known: OrderedDict[tuple, GroupSizes] = OrderedDict()


def group_sizes(df: DataFrame, keys: Sequence[str], texts: Sequence[str] = ()) -> GroupSizes:
    """The largest group of ``df`` by ``keys``, and the most bytes that one of ``texts`` has in a group.

    One number reaches the driver. A plan that was counted before, by these keys or fewer of
    them, is not counted again.
    """
    plan = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tuple(texts))
    at = (*plan, frozenset(keys))
    if at in _known:
        _known.move_to_end(at)
        return _known[at]
    size = [F.count(F.lit(1)).alias("_n")]
    size += [F.sum(F.octet_length(F.col(c).cast("string")) + 1).alias(f"_b{i}") for i, c in enumerate(texts)]
    largest = [F.max("_n"), *[F.max(f"_b{i}") for i in range(len(texts))]]
    found = df.groupBy(*keys).agg(*size).agg(*largest).first()
    _known[at] = GroupSizes(frozenset(keys), found[0] or 0, max([b or 0 for b in found[1:]], default=0))
    while len(_known) > REMEMBERED:
        _known.popitem(last=False)
    return _known[at]
