"""Keep one row per key, the latest by an ordering.

Implemented as an aggregate (``max_by``) rather than ``row_number`` over a window:
the aggregate is combined inside every task before the shuffle, so a key that holds
a third of all rows is reduced to one candidate per task instead of being sorted
whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "last") -> DataFrame:
    """Rows of ``df`` with the greatest (``keep="last"``) or smallest (``"first"``)
    ``order_by`` tuple per ``keys``.

    ``order_by`` should end in a unique column so the winner is deterministic.
    Columns keep their order.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if keep == "last" else F.min_by
    winner = pick(F.struct(*rest), F.struct(*order_by)).alias("_w")
    return df.groupBy(*keys).agg(winner).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def duplicates_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys delivered more than once and how often."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("deliveries"))
            .filter(F.col("deliveries") > 1))
