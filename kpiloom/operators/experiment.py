"""Analysis of a two-variant website experiment.

Every test here is a closed form over per-variant sufficient statistics
(counts, sums, variances).  Those come from one scan with map-side partial
aggregation; the closed forms then run on one or two rows.  Wide-to-long
reshaping is applied to the aggregated rows, not to the visits, so rows are
never multiplied by the number of metrics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.dates import week_of_year_7day
from kpiloom.functions.stats import normal_p_udf, normal_quantile, t_p_udf, t_quantile_udf
from kpiloom.plans.selection import _signed, exact_percentiles, ordered_cuts

# The experiment's two variants (baseline first, as R orders
# factor levels alphabetically) and the metric names.
LEVELS = ("tips", "tools")
LIKE_SHARE = ("clicked_like", "clicked_share")
POCOCK_3 = 1.992        # one-sided Pocock bound for three looks at alpha 0.05
TIME = "time_spent_homepage_sec"


def _rnd(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def mean_of(col: str, na_rm: bool, digits: int | None = None) -> Column:
    """R mean(): with na_rm False a group holding a NULL gives NULL."""
    x = F.col(col)
    m = F.sum(x).cast("double") / F.count(x).cast("double")
    if not na_rm:
        m = F.when(F.count(F.lit(1)) == F.count(x), m)
    return _rnd(F.when(F.count(x) > 0, m), digits)


def _long_rates(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return wide.unpivot(list(ids), list(metrics), "click_types", "conversion_rate")


def conversion_rates(visits: DataFrame, metrics: Sequence[str] = LIKE_SHARE, na_rm: bool = False) -> DataFrame:
    """Mean of each 0/1 metric per variant: click_types, condition, conversion_rate."""
    wide = visits.groupBy("condition").agg(*[mean_of(m, na_rm).alias(m) for m in metrics])
    return _long_rates(wide, ["condition"], metrics).select("click_types", "condition", "conversion_rate")


def conversion_crosstab(visits: DataFrame, metrics: Sequence[str] = LIKE_SHARE,
                        levels: Sequence[str] = LEVELS, na_rm: bool = False) -> DataFrame:
    """X1 spread to one column per variant."""
    return (conversion_rates(visits, metrics, na_rm).groupBy("click_types")
            .pivot("condition", list(levels)).agg(F.first("conversion_rate")))


def weekly_conversion(visits: DataFrame, metrics: Sequence[str] = LIKE_SHARE, na_rm: bool = False) -> DataFrame:
    """X1 per 7-day week of the year (lubridate week), sorted by week."""
    wide = (visits.groupBy(week_of_year_7day("visit_date").alias("week"), "condition")
            .agg(*[mean_of(m, na_rm).alias(m) for m in metrics]))
    return (_long_rates(wide, ["week", "condition"], metrics)
            .select("week", "condition", "click_types", "conversion_rate").orderBy("week"))


def _counts_by_level(visits: DataFrame, metric: str, levels: Sequence[str]) -> DataFrame:
    x = F.col(metric)
    aggs = []
    for i, lv in enumerate(levels):
        inl = F.col("condition") == lv
        aggs += [F.count(F.when(inl, x)).alias(f"_n{i}"), F.sum(F.when(inl, x)).alias(f"_y{i}")]
    return visits.agg(*aggs)


def logit_test(visits: DataFrame, metric: str = "clicked_like", levels: Sequence[str] = LEVELS,
               with_p: bool = True, digits: int | None = None) -> DataFrame:
    """glm(metric ~ condition, binomial) for a two-level factor, in closed form.

    With y successes of n per level: intercept = logit of the baseline,
    slope = difference of logits; standard errors from the 2x2 table; Wald z;
    two-sided normal p.  A zero cell gives NULL estimates (no finite MLE).
    """
    c = _counts_by_level(visits, metric, levels)
    ya, na, yb, nb = (F.col("_y0").cast("double"), F.col("_n0").cast("double"),
                      F.col("_y1").cast("double"), F.col("_n1").cast("double"))
    ok_a = (ya > 0) & (ya < na)
    ok = ok_a & (yb > 0) & (yb < nb)
    la = F.log(ya / (na - ya))
    lb = F.log(yb / (nb - yb))
    va = F.lit(1.0) / ya + F.lit(1.0) / (na - ya)
    vb = F.lit(1.0) / yb + F.lit(1.0) / (nb - yb)
    terms = F.array(
        F.struct(F.lit("(Intercept)").alias("term"), F.when(ok_a, la).alias("estimate"),
                 F.when(ok_a, F.sqrt(va)).alias("std_error")),
        F.struct(F.lit(f"condition{levels[1]}").alias("term"), F.when(ok, lb - la).alias("estimate"),
                 F.when(ok, F.sqrt(va + vb)).alias("std_error")))
    t = c.select(F.explode(terms).alias("t")).select("t.term", "t.estimate", "t.std_error")
    t = t.withColumn("statistic", F.col("estimate") / F.col("std_error"))
    if with_p:
        t = t.withColumn("p_value", normal_p_udf(F.col("statistic")))
    if digits is not None:
        t = t.select("term", *[F.round(k, digits).alias(k) for k in t.columns if k != "term"])
    return t


def sample_size(visits: DataFrame, metric: str = "clicked_share", lift: float = 0.05,
                segments: Sequence[str] = (), alpha: float = 0.05, power: float = 0.8,
                treatment: str = LEVELS[1]) -> DataFrame:
    """Total sample size for a logistic test on a binary covariate
    (Hsieh 1998, the formula behind SSizeLogisticBin), per segment.

    p1 = observed rate of ``metric``; p2 = p1 + lift; B = share of visits in
    ``treatment``.  n = ceil((za*sqrt(p(1-p)/B) + zb*sqrt(p1(1-p1) +
    p2(1-p2)(1-B)/B))^2 / ((p1-p2)^2 (1-B))), p = (1-B)p1 + B p2.
    """
    x = F.col(metric)
    g = visits.groupBy(*segments) if segments else visits.groupBy()
    s = g.agg(F.sum(x).cast("double").alias("_y"), F.count(x).cast("double").alias("_n"),
              F.sum(F.when(F.col("condition") == treatment, 1).otherwise(0)).cast("double").alias("_t"),
              F.count(F.lit(1)).cast("double").alias("_all"))
    za, zb = F.lit(normal_quantile(1 - alpha / 2)), F.lit(normal_quantile(power))
    p1 = F.try_divide(F.col("_y"), F.col("_n"))
    b = F.try_divide(F.col("_t"), F.col("_all"))
    s = s.select(*segments, p1.alias("p1"), (p1 + F.lit(lift)).alias("p2"), b.alias("share"))
    p1, p2, b = F.col("p1"), F.col("p2"), F.col("share")
    pbar = (F.lit(1.0) - b) * p1 + b * p2
    root = za * F.sqrt(pbar * (F.lit(1.0) - pbar) / b) + zb * F.sqrt(
        p1 * (F.lit(1.0) - p1) + p2 * (F.lit(1.0) - p2) * (F.lit(1.0) - b) / b)
    n = root * root / ((p1 - p2) * (p1 - p2) * (F.lit(1.0) - b))
    # a design needs both variants and rates inside (0, 1); otherwise no size
    ok = (b > 0) & (b < 1) & (p1 >= 0) & (p2 <= 1) & (p2 >= 0) & (p1 != p2)
    return s.select(*segments, "p1", "p2", "share", F.when(ok, F.ceil(n).cast("bigint")).alias("n"))


def sample_size_formula(p1: float, p2: float, share: float, alpha: float = 0.05, power: float = 0.8) -> int:
    """The X5 formula on plain numbers (for checks and planning)."""
    za, zb = normal_quantile(1 - alpha / 2), normal_quantile(power)
    pbar = (1 - share) * p1 + share * p2
    root = za * math.sqrt(pbar * (1 - pbar) / share) + zb * math.sqrt(
        p1 * (1 - p1) + p2 * (1 - p2) * (1 - share) / share)
    return math.ceil(root * root / ((p1 - p2) * (p1 - p2) * (1 - share)))


def sequential_looks(visits: DataFrame, metric: str = "clicked_like", n_per_group: float = 336.5,
                     k: int = 3, boundary: float | None = None, levels: Sequence[str] = LEVELS,
                     order: Sequence[str] = ("ts", "event_id"), digits: int | None = None) -> DataFrame:
    """Group-sequential looks at equally spaced information times.

    Look i uses the first floor(n_per_group * i / k) visits of each variant in
    arrival order (``order``: time and a unique tie-breaker); z is the pooled
    two-proportion statistic (treatment minus baseline); ``crossed`` when z >=
    boundary (one-sided; the Pocock bound of k = 3 by default, to be given for
    any other k), ``stop`` at the first crossing.  The last visit of each look
    is found by exact selection, and one pass then counts the visits up to it:
    no visit is numbered or sorted.  That pass takes the time of the last look
    as a filter known at run time, so the scan skips the row groups after it.
    """
    if boundary is None:
        if k != 3:
            raise ValueError("give the boundary for a number of looks other than 3")
        boundary = POCOCK_3
    points = [n_per_group * i / k for i in range(1, k + 1)]
    last = [int(math.floor(pt)) for pt in points]
    time, tie = order
    v = visits.where(F.col("condition").isin(list(levels)))
    cuts = ordered_cuts(v, {"arrival": (time, True)}, tie, lambda n: F.array(*[F.lit(x).cast("bigint") for x in last]),
                        groups=["condition"])
    first = _arrived(v, time, cuts, last[-1], levels).withColumn("_at", _signed(v, time, True)).withColumn(
        "_cuts", cuts.agg(F.collect_list(F.struct("condition", "rank", "v", "tie"))).scalar())

    def up_to(n: int) -> Column:
        """Among the first n visits of the variant; all of them if there are fewer."""
        mine = F.filter("_cuts", lambda c: (c["condition"] == F.col("condition")) & (c["rank"] == n))
        at = F.get(mine, F.lit(0))
        return F.lit(n > 0) & (at.isNull() | (F.col("_at") < at["v"]) | ((F.col("_at") == at["v"]) & (F.col(tie) <= at["tie"])))

    x = F.col(metric)
    aggs = []
    for i, pt in enumerate(points):
        within = up_to(last[i])
        for j, lv in enumerate(levels):
            sel = within & (F.col("condition") == lv)
            aggs += [F.count(F.when(sel, x)).alias(f"_n{i}_{j}"), F.sum(F.when(sel, x)).alias(f"_y{i}_{j}")]
    wide = first.agg(*aggs)
    looks = F.array(*[F.struct(F.lit(i + 1).alias("look"), F.lit(float(pt)).alias("stop_point"),
                               F.col(f"_n{i}_0").alias("n_a"), F.coalesce(F.col(f"_y{i}_0"), F.lit(0)).alias("y_a"),
                               F.col(f"_n{i}_1").alias("n_b"), F.coalesce(F.col(f"_y{i}_1"), F.lit(0)).alias("y_b"))
                      for i, pt in enumerate(points)])
    t = wide.select(F.explode(looks).alias("l")).select("l.*")
    na, ya, nb, yb = (F.col(c).cast("double") for c in ("n_a", "y_a", "n_b", "y_b"))
    pooled = (ya + yb) / (na + nb)
    se = F.sqrt(pooled * (F.lit(1.0) - pooled) * (F.lit(1.0) / na + F.lit(1.0) / nb))
    z = F.when((na > 0) & (nb > 0) & (se > 0), (yb / nb - ya / na) / se)
    t = t.withColumn("z", _rnd(z, digits)).withColumn("crossed", F.coalesce(F.col("z") >= boundary, F.lit(False)))
    first_cross = F.min(F.when(F.col("crossed"), F.col("look"))).over(Window.partitionBy())
    a, b = levels
    return (t.withColumn("stop", F.coalesce(F.col("look") == first_cross, F.lit(False)))
            .select("look", "stop_point", F.col("n_a").cast("bigint").alias(f"n_{a}"),
                    F.col("y_a").cast("bigint").alias(f"y_{a}"), F.col("n_b").cast("bigint").alias(f"n_{b}"),
                    F.col("y_b").cast("bigint").alias(f"y_{b}"), "z", "crossed", "stop")
            .orderBy("look"))


def _arrived(visits: DataFrame, time: str, cuts: DataFrame, last: int, levels: Sequence[str]) -> DataFrame:
    """The visits up to the later of the variants' ``last`` visits, by a scalar subquery that reaches the
    scan; all of them if a variant has fewer (or its last one has no time)."""
    kind = visits.schema[time].dataType.simpleString()
    if kind not in ("timestamp", "date"):
        return visits
    back = F.timestamp_micros if kind == "timestamp" else F.date_from_unix_date
    at = F.when((F.col("rank") == last) & (F.col("v") < float("inf")), F.col("v"))
    until = F.when(F.count(at) == len(set(levels)), back(F.max(at).cast("bigint" if kind == "timestamp" else "int")))
    bound = cuts.agg(F.coalesce(until, F.lit("9999-12-31").cast(kind)).alias("until")).scalar()
    return visits.where((F.col(time) <= bound) | F.col(time).isNull())


def mean_time(visits: DataFrame, na_rm: bool = True, digits: int | None = None) -> DataFrame:
    """Mean time on the homepage per variant, largest first."""
    return (visits.groupBy("condition").agg(mean_of(TIME, na_rm, digits).alias("time_spent"))
            .orderBy(F.desc("time_spent")))


FIVE_NUMBERS = {"time_min": 0.0, "time_q1": 0.25, "time_median": 0.5, "time_q3": 0.75, "time_max": 1.0}


def weekly_time(visits: DataFrame, na_rm: bool = False, digits: int | None = None,
                approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Per week and variant, the mean time (the value the reference
    boxplots) plus the real five-number summary (percentile_cont) of the
    visits behind it, all from one aggregation.  The quantiles are exact
    order statistics found by selection, so no (week, variant) group is
    sorted or sits in one task.  ``approx=True`` uses ``percentile_approx``
    instead: one pass, memory bounded by ``accuracy`` per group, values
    taken from the data (no interpolation), rank error about 1/accuracy."""
    wk = visits.select(week_of_year_7day("visit_date").alias("week"), "condition", TIME)
    if approx:
        q = wk.groupBy("week", "condition").agg(
            mean_of(TIME, na_rm, digits).alias("time_spent"),
            F.percentile_approx(TIME, list(FIVE_NUMBERS.values()), accuracy).alias("_q"))
        q = q.select("week", "condition", "time_spent",
                     *[F.col("_q")[i].alias(name) for i, name in enumerate(FIVE_NUMBERS)])
        return q.orderBy("week", "condition")
    q = exact_percentiles(wk, TIME, FIVE_NUMBERS,
                          partition_by=["week", "condition"], exact_decimal=False,
                          extra_aggs=[mean_of(TIME, na_rm, digits).alias("time_spent")])
    return (q.select("week", "condition", "time_spent",
                     *[_rnd(F.col(c), digits).alias(c)
                       for c in ("time_min", "time_q1", "time_median", "time_q3", "time_max")])
            .orderBy("week", "condition"))


def welch_test(visits: DataFrame, levels: Sequence[str] = LEVELS, with_p: bool = True,
               conf_level: float = 0.95, digits: int | None = None) -> DataFrame:
    """Welch two-sample t-test of time on page, baseline minus treatment
    (R's t.test(y ~ g)); NULL times are dropped.  One global aggregation
    yields n, mean and sample variance of both variants."""
    x = F.col(TIME)
    aggs = []
    for i, lv in enumerate(levels):
        sel = F.when(F.col("condition") == lv, x)
        aggs += [F.count(sel).cast("double").alias(f"_n{i}"), F.avg(sel).alias(f"_m{i}"),
                 F.var_samp(sel).alias(f"_v{i}")]
    s = visits.agg(*aggs)
    se2a = F.col("_v0") / F.col("_n0")
    se2b = F.col("_v1") / F.col("_n1")
    se = F.sqrt(se2a + se2b)
    # NULL (not an error) without two observations per variant or with no spread
    stat = F.when(se > 0, (F.col("_m0") - F.col("_m1")) / se)
    dfree = F.when(se > 0, (se2a + se2b) * (se2a + se2b)
                   / (se2a * se2a / (F.col("_n0") - 1) + se2b * se2b / (F.col("_n1") - 1)))
    a, b = levels
    out = s.select(stat.alias("statistic"), dfree.alias("df"), (F.col("_m0") - F.col("_m1")).alias("_diff"),
                   se.alias("_se"), F.col("_m0").alias(f"mean_{a}"), F.col("_m1").alias(f"mean_{b}"))
    cols = ["statistic", "df"]
    if with_p:
        q = t_quantile_udf(F.lit(0.5 + conf_level / 2), F.col("df"))
        out = (out.withColumn("p_value", t_p_udf(F.col("statistic"), F.col("df")))
               .withColumn("_q", q)
               .withColumn("conf_low", F.col("_diff") - F.col("_q") * F.col("_se"))
               .withColumn("conf_high", F.col("_diff") + F.col("_q") * F.col("_se")))
        cols += ["p_value", "conf_low", "conf_high"]
    cols += [f"mean_{a}", f"mean_{b}"]
    return out.select(*[_rnd(F.col(c), digits).alias(c) for c in cols])
