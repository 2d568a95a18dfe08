"""Counting values into closed intervals [lo + i*step, lo + (i+1)*step].

The SQL form is a LEFT JOIN of the bins to the values on a range condition,
which Spark plans as a nested-loop join.  Here each value emits the ids of
the (one or two, on a shared edge) bins that contain it, the ids are counted
with a normal aggregation, and the few bins are joined to the counts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.numeric import int_div

def count_in_bins(values: DataFrame, value: str, lo, hi, step, count_col: str = "customer_number") -> DataFrame:
    """One row per bin (lower_class, upper_class, count), empty bins 0; both
    ends inclusive, so a value on an edge counts in both bins; values outside
    [lo, hi] or NULL count nowhere.  ``lo``, ``hi`` and ``step`` may be
    decimal fractions; the grid must end at ``hi``."""
    first, last, width = (Decimal(str(x)) for x in (lo, hi, step))
    if width <= 0 or last <= first:
        raise ValueError("step must be positive and hi above lo")
    if (last - first) % width:
        raise ValueError(f"the bins from {lo} by {step} do not end at {hi}")
    n_bins = int((last - first) / width)
    v = F.col(value)
    off = v.cast("decimal(28,8)") - F.lit(first)
    i = int_div(off, F.lit(width))
    on_edge = (off == i * F.lit(width)) & (i >= 1)
    ids = F.when(on_edge, F.array(i - 1, i)).otherwise(F.array(i))
    hits = (values.where(v.isNotNull() & (v >= F.lit(first)) & (v <= F.lit(last)))
            .select(F.explode(ids).alias("_kl_bin"))
            .where(F.col("_kl_bin") < n_bins)
            .groupBy("_kl_bin").agg(F.count(F.lit(1)).alias(count_col)))
    whole = all(x == x.to_integral_value() for x in (first, width))
    edge = lambda k: (F.lit(first) + (F.col("id") + k) * F.lit(width)).cast("bigint" if whole else "double")
    bins = values.sparkSession.range(n_bins).select(
        F.col("id").alias("_kl_bin"), edge(0).alias("lower_class"), edge(1).alias("upper_class"))
    return (bins.join(hits, "_kl_bin", "left")
            .select("lower_class", "upper_class",
                    F.coalesce(F.col(count_col), F.lit(0)).cast("bigint").alias(count_col)))
