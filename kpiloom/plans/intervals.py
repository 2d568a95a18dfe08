"""Joining values to intervals of any borders: uneven, overlapping, gapped or open at an end.

A range condition has no key to join on, so Spark would compare every value with
every interval.  Here the distinct borders cut the line into elementary
segments, numbered in order (a border is a segment of its own, so is the gap after
it), and an interval is a run of segments.  The segment of a value is its place among the
borders: values and borders are range-partitioned together, and the borders
before a value are counted by a scan over its partition plus those of earlier
partitions.  An interval is then cut into the few aligned power-of-two blocks that
make it up, and a value asks for the block of every size that holds it: a value and an
interval that contains it meet in exactly one block, on an ordinary key.

Both ends of an interval belong to it (SQL ``BETWEEN``); a NULL end is open.  NULL
values are in no interval, and an interval whose lower end lies above the upper
one holds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import stored


def _numbered(values: DataFrame, borders: DataFrame) -> DataFrame:
    """(v, border, k): distinct values and borders with the number of borders up to each."""
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = values.select("v", F.lit(False).alias("border")).unionByName(borders.select("v", F.lit(True).alias("border")))
    points = points.where("v IS NOT NULL").groupBy("v").agg(F.max("border").alias("border"))
    placed = stored(points.repartitionByRange(n, "v").sortWithinPartitions("v").withColumn("at", F.monotonically_increasing_id())) \
        .withColumn("part", F.shiftright("at", 33))
    one = F.col("border").cast("long")
    parts = placed.groupBy("part").agg(F.sum(one).alias("c"))
    before = parts.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("earlier"))    # a row per partition
    run = F.sum(one).over(Window.partitionBy("part").orderBy("at"))
    return placed.withColumn("run", run).join(before, "part").select("v", "border", (F.col("run") + F.col("earlier")).alias("k"))


def _places(values: DataFrame, value: str, intervals: DataFrame, lower: str, upper: str) -> tuple[DataFrame, DataFrame]:
    """(v, seg) of the distinct values, and the intervals' rows with the run of segments (lo, hi) of each."""
    ends = intervals.select(F.col(lower).alias("v")).union(intervals.select(F.col(upper).alias("v")))
    common = values.select(F.col(value).alias("v")).union(ends).schema["v"].dataType
    points = _numbered(values.select(F.col(value).cast(common).alias("v")), ends.select(F.col("v").cast(common).alias("v")))
    k = F.col("k")
    seg = points.select("v", F.when(F.col("border"), 2 * k).otherwise(2 * k + 1).alias("seg"), "border")
    at = seg.where("border").select("v", "seg")
    last = at.agg((F.coalesce(F.max("seg"), F.lit(0)) + 1).alias("m")).select("m").scalar()
    runs = intervals
    for name, side, open_end in (("_kl_lo", lower, F.lit(1)), ("_kl_hi", upper, last)):
        found = at.select(F.col("v").alias("_kl_v"), F.col("seg").alias("_kl_seg"))
        runs = runs.join(found, runs[side].cast(common) == F.col("_kl_v"), "left") \
            .withColumn(name, F.when(F.col(side).isNull(), open_end.cast("long")).otherwise(F.col("_kl_seg"))).drop("_kl_v", "_kl_seg")
    return seg.select("v", "seg"), runs.withColumn("_kl_top", F.floor(F.log2(last.cast("double") + 1)).cast("int"))


def _blocks_of_run(lo: Column, hi: Column, top: Column) -> Column:
    """The aligned blocks (size as a power of two, number) that make up the segments lo..hi."""
    def at(j):
        size = F.pow(F.lit(2.0), j)
        left, right = F.ceil(lo / size).cast("long"), F.floor((hi + 1) / size).cast("long")
        some = left < right
        return F.array(F.when(some & (left % 2 == 1), F.struct(j.alias("level"), left.alias("block"))),
                       F.when(some & (right % 2 == 1), F.struct(j.alias("level"), (right - 1).alias("block"))))
    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), top), at)))


def _blocks_of_segment(seg: Column, top: Column) -> Column:
    """The block of every size that holds a segment."""
    return F.transform(F.sequence(F.lit(0), top), lambda j: F.struct(
        j.alias("level"), F.floor(seg / F.pow(F.lit(2.0), j)).cast("long").alias("block")))


def _interval_blocks(runs: DataFrame, keep: Sequence[str]) -> DataFrame:
    return runs.where("_kl_lo <= _kl_hi").select(*keep, F.explode(_blocks_of_run(F.col("_kl_lo"), F.col("_kl_hi"), F.col("_kl_top"))).alias("x")) \
        .select(*keep, F.col("x.level").alias("_kl_level"), F.col("x.block").alias("_kl_block"))


def _value_blocks(places: DataFrame, runs: DataFrame, *keep: str) -> DataFrame:
    top = runs.agg(F.coalesce(F.max("_kl_top"), F.lit(0)).alias("t")).scalar()
    return places.withColumn("_kl_top", top) \
        .select(*keep, F.explode(_blocks_of_segment(F.col("seg"), F.col("_kl_top"))).alias("x")) \
        .select(*keep, F.col("x.level").alias("_kl_level"), F.col("x.block").alias("_kl_block"))


def interval_join(values: DataFrame, value: str, intervals: DataFrame, lower: str, upper: str, how: str = "inner") -> DataFrame:
    """Every value row with every interval row that contains its value.

    ``how="left"`` keeps value rows that are in no interval, once, with NULLs.
    The two inputs must not share column names.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    if shared := set(values.columns) & set(intervals.columns):
        raise ValueError(f"both sides have columns {sorted(shared)}")
    places, runs = _places(values, value, intervals, lower, upper)
    held = _value_blocks(places, runs, "v").join(_interval_blocks(runs, intervals.columns), ["_kl_level", "_kl_block"]) \
        .drop("_kl_level", "_kl_block").withColumnRenamed("v", "_kl_value")
    return values.join(held, F.col(value).cast(places.schema["v"].dataType) == F.col("_kl_value"), how).drop("_kl_value")


def count_in_intervals(values: DataFrame, value: str, intervals: DataFrame, lower: str, upper: str, count_col: str) -> DataFrame:
    """The interval rows with the number of values in each, 0 for an empty one.

    Values are counted by value, then by segment, then by block: a value held by a third of
    the rows travels as one row, and no (value, interval) pair is made.
    """
    places, runs = _places(values, value, intervals, lower, upper)
    counts = values.select(F.col(value).cast(places.schema["v"].dataType).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("_kl_c"))
    segments = counts.join(places, "v").groupBy("seg").agg(F.sum("_kl_c").alias("_kl_c"))
    blocks = _value_blocks(segments, runs, "_kl_c").groupBy("_kl_level", "_kl_block").agg(F.sum("_kl_c").alias("_kl_c"))
    keys = list(intervals.columns)
    totals = _interval_blocks(runs, keys).join(blocks, ["_kl_level", "_kl_block"]).groupBy(*keys).agg(F.sum("_kl_c").alias(count_col))
    # equal intervals count alike: each block joins all of them, so the sum is shared out by their number
    copies = intervals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kl_n"))
    same = [copies[c].eqNullSafe(totals[c]) for c in keys]
    on = same[0]
    for c in same[1:]:
        on = on & c
    total = (F.coalesce(totals[count_col], F.lit(0)) / F.col("_kl_n")).cast("bigint")
    return copies.join(totals, on, "left") \
        .select(*[copies[c] for c in keys], F.explode(F.array_repeat(total, F.col("_kl_n").cast("int"))).alias(count_col))
