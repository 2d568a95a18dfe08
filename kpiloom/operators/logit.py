"""X4 for factors of any number of levels, and several of them: a logistic regression by Newton steps.

The visits collapse to one row per combination of levels (visits and successes),
which is all the model needs.  A step is one aggregation over those cells: each
cell adds to the score and the information of the coefficients it has, as (row,
column) sums; the driver receives those sums only, as many as coefficients
squared, and solves for the step.  Start and stop follow R's ``glm``: fitted means
(y + 1/2) / (n + 1), at most 25 steps, until the deviance changes by less than 1e-8
of itself.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.stats import normal_p_udf
from kpiloom.session import stored

# R's glm.control
MAX_STEPS, EPSILON = 25, 1e-8
MAX_LEVELS = 1000          # coefficients a model may have (the driver solves a square of them)


def _cells(visits: DataFrame, metric: str, factors: Sequence[str]) -> DataFrame:
    """(levels, n, y): visits and successes per combination of levels; rows with a NULL anywhere are left out."""
    named = [F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(factors)]
    rows = visits.select(*named, F.col(metric).cast("double").alias("y")).dropna()
    return stored(rows.groupBy(*[f"f{i}" for i in range(len(factors))])
                  .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("y")))


def _terms(cells: DataFrame, factors: Sequence[str]) -> list[tuple[int, str]]:
    """(factor, level) of every coefficient but the intercept; each factor's first level in order is the baseline."""
    out = []
    for i, f in enumerate(factors):
        levels = [r[0] for r in cells.select(f"f{i}").distinct().orderBy(f"f{i}").limit(MAX_LEVELS + 2).collect()]
        if len(levels) < 2:
            raise ValueError(f"{f} has {len(levels)} level(s); a factor needs two")
        out += [(i, level) for level in levels[1:]]
    if len(out) >= MAX_LEVELS:
        raise ValueError(f"more than {MAX_LEVELS} coefficients")
    return out


def _sums(cells: DataFrame, terms: Sequence[tuple[int, str]], beta: np.ndarray | None):
    """(deviance, score, information) of the coefficients, by one aggregation."""
    places = F.array_compact(F.array(F.lit(0), *[F.when(F.col(f"f{i}") == level, F.lit(k)) for k, (i, level) in enumerate(terms, 1)]))
    if beta is None:
        mean = (F.col("y") + 0.5) / (F.col("n") + 1)
        line = F.log(mean / (1 - mean))
    else:
        weights = F.array(*[F.lit(float(b)) for b in beta])
        line = F.aggregate("at", F.lit(0.0), lambda s, k: s + F.get(weights, k))
        mean = 1 / (1 + F.exp(-F.col("line")))
    c = cells.withColumn("at", places).withColumn("line", line).withColumn("mean", mean)
    n, y, m = F.col("n"), F.col("y"), F.col("mean")
    w = n * m * (1 - m)
    # at the start there is no coefficient yet: the step solves for the working response itself
    gain = y - n * m if beta is not None else w * (F.col("line") + (y - n * m) / w)

    def share(part: Column, mean: Column) -> Column:        # part * log(part / mean), 0 for none
        return F.when(part > 0, part * F.log(part / mean)).otherwise(0.0)

    deviance = 2 * (share(y, n * m) + share(n - y, n * (1 - m)))
    entry = lambda i, j, v: F.struct(i.alias("i"), j.alias("j"), v.alias("v"))
    none = F.lit(-1)
    pairs = F.flatten(F.transform("at", lambda i: F.transform("at", lambda j: entry(i, j, F.col("w")))))
    singles = F.transform("at", lambda i: entry(i, none, F.col("gain")))
    parts = c.withColumns({"w": w, "gain": gain, "dev": deviance}) \
        .select(F.explode(F.concat(pairs, singles, F.array(entry(none, none, F.col("dev"))))).alias("e")).select("e.*")
    size = len(terms) + 1
    score, info, dev = np.zeros(size), np.zeros((size, size)), 0.0
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():     # coefficients squared
        if r.i < 0:
            dev = r.v
        elif r.j < 0:
            score[r.i] = r.v
        else:
            info[r.i, r.j] = r.v
    return dev, score, info


def logit_model(visits: DataFrame, metric: str, factors: Sequence[str], with_p: bool = True, digits: int | None = None) -> DataFrame:
    """glm(metric ~ factors, binomial) without interactions: (term, estimate, std_error, statistic, p_value).

    Terms are named as R names them, factor then level, levels in text order.
    A model without a finite fit (a level with only successes or none, factors that determine
    each other) has NULL estimates.
    """
    cells = _cells(visits, metric, factors)
    terms = _terms(cells, factors)
    names = ["(Intercept)", *[f"{factors[i]}{level}" for i, level in terms]]
    beta, last, fit = None, None, None
    for _ in range(MAX_STEPS + 1):
        dev, score, info = _sums(cells, terms, beta)
        if not np.isfinite(info).all() or np.linalg.matrix_rank(info) < len(names):
            break
        if last is not None and abs(dev - last) / (abs(dev) + 0.1) < EPSILON:
            fit = np.sqrt(np.diag(np.linalg.inv(info)))
            break
        last = dev if beta is not None else None
        step = np.linalg.solve(info, score)
        beta = step if beta is None else beta + step
    if fit is not None and (np.abs(beta) > 15).any():       # on its way to an infinite estimate
        fit = None
    rows = [(k, t, float(beta[k]) if fit is not None else None, float(fit[k]) if fit is not None else None) for k, t in enumerate(names)]
    t = visits.sparkSession.createDataFrame(rows, "k int, term string, estimate double, std_error double").orderBy("k")
    t = t.select("term", "estimate", "std_error", (F.col("estimate") / F.col("std_error")).alias("statistic"))
    if with_p:
        t = t.withColumn("p_value", normal_p_udf(F.col("statistic")))
    if digits is not None:
        t = t.select("term", *[F.round(c, digits).alias(c) for c in t.columns if c != "term"])
    return t
