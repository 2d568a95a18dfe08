"""Top-k per group without putting a whole group through one task.

A rank filter over a window (``dense_rank() <= k``) is planned by Spark with
``WindowGroupLimit`` on *both* sides of the exchange: each map task first
keeps, per group, only the rows that can still rank within k (all ties kept),
and only those cross the shuffle.  A group holding a third of the input
therefore ships at most k values (plus their ties, which belong to the result
anyway) from every map task.  ``assert_group_limit`` checks the plan has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_distinct_per_group(df: DataFrame, group_cols: Sequence[str], value: str, k: int,
                             descending: bool = True, out: str = "rank") -> DataFrame:
    """Rows whose ``value`` is among the k best distinct values of their group,
    with that value's dense rank (ties all kept, so a group may give more than k rows)."""
    order = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    w = Window.partitionBy(*group_cols).orderBy(order)
    return df.withColumn(out, F.dense_rank().over(w).cast("bigint")).where(F.col(out) <= k)


def assert_group_limit(df: DataFrame) -> None:
    """Raise unless the executed plan limits rows per group before the shuffle."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "WindowGroupLimit" not in plan:
        raise AssertionError("no WindowGroupLimit in plan:\n" + plan)
