"""Exact order statistics without sorting a table, and ranks built on them.

``at_ranks`` finds the row at given row numbers of each group in one plan
that is the same at every size, starts no job while it is built and reads its
input twice:

1. one aggregation gives each group's size and a grid of approximate
   quantiles (a mergeable sketch, so a hot group costs one sketch per task);
2. every wanted row number is bracketed by two grid values a few steps apart;
3. a second aggregation counts rows: those inside a bracket by their value
   (and tie), all others by the gap they fall into, so about GRID_MARGIN / GRID
   of a group's rows are kept;
4. running counts over those few cells name the exact row and the number of
   rows before it.  A row number that fell outside its bracket would raise.

Orders by (value, tie) use one sketch over a number that follows both: the value
plus a part of its smallest step that grows with the tie (``order_key``).  So a
value held by a third of the rows is cut inside, and ties need no second pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.numeric import int_div

GRID, GRID_MARGIN = 1000, 2        # grid steps of a sketch, steps on each side of a bracket
CLASS_STEPS = 32                   # dense_rank: classes are its square
ACCURACY = 20_000                  # rank error of a sketch: 1 / ACCURACY of its rows


def order_key(v: Column, tie: Column, step: float | Column) -> Column:
    """A double that never falls along the order (v, tie), for values at least ``step`` apart (0: unknown).

    The tie's share lies between 0 and 1 and follows its logarithm; an infinite
    value (NULL's place in the order) is a large finite one, so that it is cut
    by ties as well.  Rounding may merge neighbours, never swap them.
    """
    t = tie.cast("double")
    share = F.lit(0.5) + F.signum(t) * F.log2(F.abs(t) + 1) / 130
    far = F.lit(1e300)
    return F.when(v == float("inf"), far * (1 + share)).when(v == float("-inf"), far * (share - 2)) \
        .otherwise(v.cast("double") + step * share)


def _stats(src: DataFrame, groups: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """Per group: size, quantile grid of the key, and what else is asked for."""
    steps = [i / GRID for i in range(GRID + 1)]
    return src.groupBy(*groups).agg(F.count("_kl_v").alias("_kl_n"),
                                    F.percentile_approx("_kl_m", steps, ACCURACY).alias("_kl_grid"), *extra)


def _hits(src: DataFrame, stats: DataFrame, groups: Sequence[str], ranks: Callable[[Column], Column]) -> DataFrame:
    """(groups, n, rank, value, tie, before) of ``src`` rows (groups, _kl_v, _kl_t, _kl_m)."""
    n = F.col("_kl_n")
    low = lambda r: F.greatest(F.floor((r - 1) * GRID / n).cast("int") - GRID_MARGIN, F.lit(0))
    high = lambda r: F.least(F.ceil(r * GRID / n).cast("int") + GRID_MARGIN, F.lit(GRID))
    inside = F.filter(ranks(n), lambda r: (r >= 1) & (r <= n))
    spans = stats.withColumn("_kl_ranks", inside).withColumn("_kl_in", F.transform("_kl_ranks", lambda r: F.struct(
        F.get("_kl_grid", low(r)).alias("lo"), F.get("_kl_grid", high(r)).alias("hi"))))
    spans = spans.select(*[F.col(k).alias(f"_kl_b{i}") for i, k in enumerate(groups)],
                         F.struct("_kl_n", "_kl_ranks", "_kl_in").alias("_kl_s"))
    rows = src.where(F.col("_kl_v").isNotNull())
    # one group of all rows: its brackets are a scalar subquery
    both = rows.join(spans, _same(groups, [f"_kl_b{i}" for i in range(len(groups))])) if groups \
        else rows.withColumn("_kl_s", spans.select("_kl_s").scalar())
    m, at = F.col("_kl_m"), F.col("_kl_s._kl_in")
    held = F.exists(at, lambda b: (m >= b["lo"]) & (m <= b["hi"]))
    gap = F.array_max(F.filter(F.transform(at, lambda b: b["hi"]), lambda x: x < m))
    marked = both.select(*groups, "_kl_v", "_kl_t", "_kl_m", held.alias("_kl_held"), gap.alias("_kl_gap"),
                         F.col("_kl_s._kl_n").alias("_kl_n"), F.col("_kl_s._kl_ranks").alias("_kl_ranks"))
    cell = lambda c: F.when(F.col("_kl_held"), F.col(c)).alias(c)
    keys = [*groups, "_kl_n", "_kl_ranks", "_kl_cell", "_kl_held", "_kl_v", "_kl_t"]
    cells = marked.select(*groups, "_kl_n", "_kl_ranks", F.when(F.col("_kl_held"), m).otherwise(F.col("_kl_gap")).alias("_kl_cell"),
                          "_kl_held", cell("_kl_v"), cell("_kl_t")).groupBy(*keys).agg(F.count(F.lit(1)).alias("_kl_c"))
    order = Window.partitionBy(*groups).orderBy(F.col("_kl_cell").asc_nulls_first(), F.col("_kl_held").desc(), "_kl_v", "_kl_t")
    run = cells.withColumn("_kl_upto", F.sum("_kl_c").over(order)).withColumn("_kl_before", F.col("_kl_upto") - F.col("_kl_c"))
    hits = run.withColumn("rank", F.explode(F.filter(
        "_kl_ranks", lambda r: (r > F.col("_kl_before")) & (r <= F.col("_kl_upto")))))
    # names the rank, so that it is checked on the rows found only
    exact = F.when(F.col("_kl_held") | (F.col("rank") < 1), F.col("_kl_v")).otherwise(
        F.raise_error(F.lit("a rank lies outside its bracket")).cast(src.schema["_kl_v"].dataType))
    return hits.select(*groups, F.col("_kl_n").alias("n"), "rank", exact.alias("value"), F.col("_kl_t").alias("tie"),
                       F.col("_kl_before").alias("before"))


def at_ranks(rows: DataFrame, groups: Sequence[str], value: str, ranks: Callable[[Column], Column],
             tie: str | None = None, key: Column | None = None) -> DataFrame:
    """(groups, n, rank, value, tie, before): the row at each 1-based rank of ``ranks(n)``.

    Ascending order by value and ``tie``, NULL values not counted; without a tie,
    ``before`` is the number of rows with a smaller value.  ``key`` is a double
    that never falls along the order.  Ranks outside 1..n are left out.
    """
    v = F.col(value)
    src = rows.select(*groups, v.alias("_kl_v"), (F.col(tie) if tie else F.lit(0)).alias("_kl_t"),
                      (v if key is None else key).alias("_kl_m"))
    return _hits(src, _stats(src, groups), list(groups), ranks)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    out = None
    for a, b in zip(left, right):
        c = F.col(a).eqNullSafe(F.col(b))
        out = c if out is None else out & c
    return out


def exact_percentiles(df: DataFrame, value: str, probs: dict[str, float], partition_by: Sequence[str] = (),
                      exact_decimal: bool = True, extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """percentile_cont for several fractions, exactly, per group, and ``extra_aggs`` of its rows.

    Decimal inputs interpolate in decimal; others in double as lo + (hi - lo) *
    frac.  NULL values are not counted; a group of only NULLs gives NULL.
    """
    groups = list(partition_by)
    names = list(probs)
    position = {k: (F.lit(Decimal(str(p))), p) for k, p in probs.items()}
    h = lambda n, k: (n - 1) * position[k][0]
    both = lambda n: F.array_distinct(F.flatten(F.array(*[
        F.array((F.floor(h(n, k)) + 1).cast("bigint"), (F.ceil(h(n, k)) + 1).cast("bigint")) for k in names])))
    v = F.col(value)
    src = df.withColumns({"_kl_v": v, "_kl_t": F.lit(0), "_kl_m": v})
    stats = _stats(src, groups, extra_aggs)
    found = _hits(src.select(*groups, "_kl_v", "_kl_t", "_kl_m"), stats.select(*groups, "_kl_n", "_kl_grid"), groups, both)
    values = F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_kl_at")
    if groups:      # one row per group: rank -> value
        table = found.groupBy(*groups).agg(values).select(*[F.col(k).alias(f"_kl_t{i}") for i, k in enumerate(groups)], "_kl_at")
        joined = stats.join(table, _same(groups, [f"_kl_t{i}" for i in range(len(groups))]), "left")
    else:
        joined = stats.withColumn("_kl_at", found.agg(values).scalar())
    names_extra = [c for c in stats.columns if c not in (*groups, "_kl_n", "_kl_grid")]
    out = []
    for k in names:
        at = h(F.col("_kl_n"), k)
        lo = F.element_at("_kl_at", (F.floor(at) + 1).cast("bigint"))
        hi = F.element_at("_kl_at", (F.ceil(at) + 1).cast("bigint"))
        frac = at - F.floor(at)
        out.append((lo + (hi - lo) * (frac if exact_decimal else frac.cast("double"))).alias(k))
    return joined.select(*groups, *out, *names_extra)


def _signed(df: DataFrame, col: str, ascending: bool) -> Column:
    """The column as a double whose ascending order is the wanted one; PostgreSQL's NULL
    order (last ascending, first descending)."""
    c = F.col(col)
    if df.schema[col].dataType.simpleString() in ("date", "timestamp", "timestamp_ntz"):
        c = F.unix_micros(c.cast("timestamp")) if "timestamp" in df.schema[col].dataType.simpleString() \
            else F.unix_date(c)
    c = c.cast("double")
    return F.coalesce(c, F.lit(float("inf"))) if ascending else F.coalesce(-c, F.lit(float("-inf")))


def _step(df: DataFrame, col: str) -> float:
    """How far two different values of a column lie apart at least (doubles: sums of MONEY lines, or unknown)."""
    kind = df.schema[col].dataType
    name = kind.simpleString()
    return 0.0 if name in ("float", "double") else 10.0 ** -kind.scale if name.startswith("decimal") else 1.0


def ordered_cuts(df: DataFrame, scores: dict[str, tuple[str, bool]], tie: str,
                 ranks: Callable[[Column], Column], groups: Sequence[str] = ()) -> DataFrame:
    """(groups, score, rank, v, tie): the rows at ``ranks(n)`` of each score's order (column,
    ascending), ties by ``tie`` (unique) ascending; ``v`` is the signed value."""
    arms = F.array(*[F.struct(F.lit(s).alias("score"), _signed(df, c, asc).alias("v"), F.lit(_step(df, c)).alias("step"))
                     for s, (c, asc) in scores.items()])
    long = df.select(*groups, F.col(tie).alias("tie"), F.explode(arms).alias("x")) \
        .select(*groups, "tie", "x.score", "x.v", order_key(F.col("x.v"), F.col("tie"), F.col("x.step")).alias("m"))
    return at_ranks(long, [*groups, "score"], "v", ranks, "tie", F.col("m")) \
        .select(*groups, "score", "rank", F.col("value").alias("v"), "tie")


def ntiles(df: DataFrame, tiles: int, scores: dict[str, tuple[str, bool]], tie: str) -> DataFrame:
    """SQL ntile(tiles) of several orders at once: one column per score.

    Only the first row of each tile is looked for (tiles - 1 a score); a row's
    tile is one more than the number of those at or before it.
    """
    def starts(n: Column) -> Column:
        q = int_div(n, F.lit(tiles))
        extra = n - q * tiles
        return F.array(*[(q * t + F.least(F.lit(t).cast("bigint"), extra) + 1).cast("bigint") for t in range(1, tiles)])

    cuts = ordered_cuts(df, scores, tie, starts).agg(F.collect_list(F.struct("score", "v", "tie"))).scalar()
    out = df.withColumn("_kl_cuts", cuts)          # a scalar subquery: a few rows
    return out.select(*df.columns, *[
        (F.size(_passed(F.col("_kl_cuts"), s, _signed(df, c, asc), F.col(tie))) + 1).cast("bigint").alias(s)
        for s, (c, asc) in scores.items()])


def _passed(cuts: Column, score: str, v: Column, tie: Column) -> Column:
    return F.filter(cuts, lambda x: (x["score"] == score) & ((x["v"] < v) | ((x["v"] == v) & (x["tie"] <= tie))))


def dense_rank(df: DataFrame, value: str, out: str = "dense_rank") -> DataFrame:
    """SQL dense_rank over the whole table by ``value`` descending (NULL first).

    Distinct values are dealt to classes between the quantiles of a sketch of
    them, so classes follow the data: distinct values have no ties, and none
    of the CLASS_STEPS ** 2 classes holds more than its share plus 2 / ACCURACY
    of them, however narrow their range (values that agree as doubles share a
    class).  A value's rank is the number of distinct values in higher classes
    (a table of one row a class) plus its rank in its own class.
    """
    values = _classed(df.select(F.col(value).alias("_kl_v")).distinct())
    per_class = values.groupBy("_kl_class").agg(F.count(F.lit(1)).alias("_kl_c"))
    higher = Window.orderBy(F.col("_kl_class").desc_nulls_first())
    before = per_class.select(F.col("_kl_class").alias("_kl_k"), (F.sum("_kl_c").over(higher) - F.col("_kl_c")).alias("_kl_before"))
    own = Window.partitionBy("_kl_class").orderBy(F.col("_kl_v").desc_nulls_first())
    ranked = values.withColumn("_kl_own", F.row_number().over(own)) \
        .join(before, F.col("_kl_class").eqNullSafe(F.col("_kl_k"))) \
        .select("_kl_v", (F.col("_kl_own") + F.col("_kl_before")).cast("bigint").alias(out))
    return df.join(ranked, F.col(value).eqNullSafe(F.col("_kl_v"))).drop("_kl_v")


def _classed(values: DataFrame) -> DataFrame:
    """Distinct values (_kl_v) with the number of their class, which grows with them (NULL stays)."""
    k, m = CLASS_STEPS, F.col("_kl_v").cast("double")
    steps = [i / (k * k) for i in range(1, k * k)]
    found = values.agg(F.percentile_approx(F.when(~F.isnan(m), m), steps, ACCURACY).alias("b"))
    # every k-th border, then the borders between two of them: 2 k comparisons a value
    borders = found.select(F.struct(F.expr(f"filter(b, (x, i) -> i % {k} = {k - 1})").alias("coarse"),
                                    F.col("b").alias("fine"))).scalar()
    below = lambda x: F.coalesce(F.size(F.filter(x, lambda b: b < m)), F.lit(0))
    at = values.withColumn("_kl_b", borders).withColumn("_kl_at", below(F.col("_kl_b.coarse")) * k)
    own = F.col("_kl_at") + below(F.slice("_kl_b.fine", F.col("_kl_at") + 1, F.lit(k - 1)))
    return at.select("_kl_v", F.when(m.isNotNull(), own).alias("_kl_class"))
