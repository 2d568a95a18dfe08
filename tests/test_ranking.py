"""Order statistics, ntile and ranks by selection must equal the plain windows,
including with one value holding a third of the rows."""

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kpiloom.plans import selection
from kpiloom.plans import at_ranks, count_in_bins, dense_rank, exact_percentiles, ntiles, ordered_cuts
from kpiloom.plans.topk import assert_group_limit, top_k_distinct_per_group


@pytest.fixture(scope="module")
def skewed(spark):
    # 30,000 rows; value 7 holds a third of them; groups g in 0..4, group 0 is hot
    return (spark.range(30_000)
            .select(F.col("id"),
                    F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") * 7919) % 1000).alias("v"),
                    F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 5).alias("g"),
                    ((F.col("id") * 31) % 997 / 7).alias("x"),
                    F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 50).alias("n")))


def _jobs(spark, build):
    """Result of ``build`` and the number of jobs it started."""
    sc = spark.sparkContext
    sc.setJobGroup("build", "")
    out = build()
    n = len(sc.statusTracker().getJobIdsForGroup("build"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return out, n


@pytest.mark.parametrize("tiles", [3, 5, 7])
def test_ntiles_equal_windows(spark, skewed, tiles):
    r, jobs = _jobs(spark, lambda: ntiles(skewed, tiles, {"a": ("v", False), "b": ("x", True), "c": ("n", True),
                                                          "d": ("n", False)}, "id"))
    assert jobs == 0
    w = skewed
    for name, order in (("wa", F.col("v").desc()), ("wb", F.col("x").asc()), ("wc", F.col("n").asc_nulls_last()),
                        ("wd", F.col("n").desc_nulls_first())):
        w = w.withColumn(name, F.ntile(tiles).over(Window.orderBy(order, "id")))
    both = r.join(w.select("id", "wa", "wb", "wc", "wd"), "id")
    assert both.count() == 30_000
    assert both.where("a <> wa or b <> wb or c <> wc or d <> wd").isEmpty()
    assert "SinglePartition" not in r._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 6, 11, 23])
def test_ntile_small_sizes(spark, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") % 3).alias("v"))
    w = df.withColumn("w", F.ntile(5).over(Window.orderBy(F.desc("v"), "id")))
    r = ntiles(df, 5, {"t": ("v", False)}, "id").join(w.select("id", "w"), "id")
    assert r.count() == n and r.where("t <> w").isEmpty()


def test_dense_rank_equals_window(spark, skewed):
    df = skewed.select("id", (F.col("x") - 70).alias("x"), F.when(F.col("id") % 13 == 0, None)
                       .otherwise(F.col("x") - 70).cast("decimal(20,4)").alias("y"))
    for c in ("x", "y"):
        r, jobs = _jobs(spark, lambda: dense_rank(df, c, "r"))
        w = df.withColumn("w", F.dense_rank().over(Window.orderBy(F.col(c).desc_nulls_first()))).select("id", "w")
        both = r.join(w, "id")
        assert jobs == 0 and both.count() == 30_000 and both.where("r <> w").isEmpty()


def test_dense_rank_of_a_narrow_range_has_even_classes(spark):
    """All values within a millionth of each other, and a lone far one: no class passes twice the mean."""
    df = spark.range(40_000).select("id", (F.lit(1e6) + ((F.col("id") * 7919) % 20_011) / 1e5).alias("v")) \
        .unionByName(spark.range(1).select(F.lit(-1).alias("id"), F.lit(9e300).alias("v")))
    per_class = selection._classed(df.select(F.col("v").alias("_kl_v")).distinct()).groupBy("_kl_class").count()
    n, total, largest = per_class.agg(F.count("*"), F.sum("count"), F.max("count")).first()
    assert n > 900 and total == 20_012 and largest <= 2 * total / n
    r = dense_rank(df, "v", "r")
    w = df.withColumn("w", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_first()))).select("id", "w")
    assert r.join(w, "id").where("r = w").count() == 40_001


def test_dense_rank_of_few_null_and_nan_values(spark):
    rows = [(i, v) for i, v in enumerate([None, None, float("nan"), float("inf"), 3.0, 3.0, 0.0, -1.0, float("-inf")])]
    df = spark.createDataFrame(rows, "id int, v double")
    got = {r.id: r.dense_rank for r in dense_rank(df, "v").collect()}
    assert got == {0: 1, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 5, 7: 6, 8: 7}
    assert dense_rank(df.limit(0), "v").count() == 0
    nothing = dense_rank(df.where("v IS NULL"), "v").collect()
    assert [r.dense_rank for r in nothing] == [1, 1]


def test_exact_percentiles_match_duckdb(spark, skewed):
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    con = duckdb.connect()
    con.register("t", skewed.toPandas())
    want = {r[0]: r[1:] for r in con.execute(
        "SELECT g, " + ", ".join(f"quantile_cont(x, {p})" for p in probs.values()) + " FROM t GROUP BY g").fetchall()}
    got, jobs = _jobs(spark, lambda: exact_percentiles(skewed, "x", probs, ["g"], exact_decimal=False))
    assert jobs == 0
    for row in got.collect():
        assert tuple(row[k] for k in probs) == pytest.approx(want[row.g], rel=1e-12)
    hot = exact_percentiles(skewed, "v", {"m": 0.5}, exact_decimal=False).first().m
    assert hot == con.execute("SELECT quantile_cont(v, 0.5) FROM t").fetchone()[0]
    assert exact_percentiles(skewed.limit(0), "x", {"m": 0.5}).first().m is None
    assert exact_percentiles(skewed.where("n is null"), "n", {"m": 0.5}, ["g"]).first().m is None


def test_at_ranks_and_cuts(skewed):
    rows = sorted((r.v, r.id) for r in skewed.select("v", "id").collect())
    got = at_ranks(skewed, [], "v", lambda n: F.array(*[F.lit(x).cast("bigint") for x in (0, 1, 9000, 30_000, 40_000)]))
    values = [v for v, _ in rows]
    assert sorted((r["rank"], r.value, r.before) for r in got.collect()) == [
        (k, values[k - 1], values.index(values[k - 1])) for k in (1, 9000, 30_000)]
    cut = ordered_cuts(skewed, {"s": ("v", True)}, "id", lambda n: F.array(F.lit(5000).cast("bigint")), ["g"]).collect()
    by_group = {r.g: (r.v, r.tie) for r in cut}
    mine = sorted((r.v, r.id) for r in skewed.where("g = 0").select("v", "id").collect())
    assert by_group[0] == mine[4999]


def test_top_k(skewed):
    top = top_k_distinct_per_group(skewed, ["g"], "v", 3, out="rank")
    assert_group_limit(top)
    pdf = skewed.toPandas()
    for g, part in pdf.groupby("g"):
        best = sorted(part.v.unique(), reverse=True)[:3]
        assert top.where(F.col("g") == int(g)).count() == int(part.v.isin(best).sum())


def test_bins_counts(spark):
    vals = spark.createDataFrame([(v,) for v in [0, 5, 10, 15, 20, 21, -1, None]], "v int")
    got = [tuple(r) for r in count_in_bins(vals, "v", 0, 20, 10, "n").orderBy("lower_class").collect()]
    assert got == [(0, 10, 3), (10, 20, 3)]
    half = spark.createDataFrame([(0.0,), (0.5,), (0.75,), (1.0,)], "v double")
    got = [tuple(r) for r in count_in_bins(half, "v", 0, 1, 0.5, "n").orderBy("lower_class").collect()]
    assert got == [(0.0, 0.5, 2), (0.5, 1.0, 3)]
    assert count_in_bins(vals, "v", 0, 200_000, 1, "n").where("n > 0").count() == 10
    for bad in ((0, 10, 20), (0, 25, 10), (0, 10, 0)):
        with pytest.raises(ValueError):
            count_in_bins(vals, "v", *bad)
