"""Interval joins against a plain loop; their plans hold no nested loop."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kpiloom.plans.intervals import count_in_intervals, interval_join


def inside(v, lo, hi):
    return v is not None and (lo is None or v >= lo) and (hi is None or v <= hi)


def frames(spark, values, intervals):
    vs = spark.createDataFrame(list(enumerate(values)), "i int, v double").repartition(3)
    return vs, spark.createDataFrame([(k, *b) for k, b in enumerate(intervals)], "b int, lo double, hi double")


def check(spark, values, intervals):
    vs, bs = frames(spark, values, intervals)
    got = sorted((r.b, r.n) for r in count_in_intervals(vs, "v", bs, "lo", "hi", "n").collect())
    assert got == [(k, sum(inside(v, *b) for v in values)) for k, b in enumerate(intervals)]
    pairs = sorted((r.i, r.b) for r in interval_join(vs, "v", bs, "lo", "hi").collect())
    assert pairs == sorted((i, k) for i, v in enumerate(values) for k, b in enumerate(intervals) if inside(v, *b))


def test_overlapping_gapped_open_and_empty_intervals(spark):
    rnd = random.Random(2)
    values = [rnd.choice([None, 7.0, rnd.randrange(-20, 60) / 2]) for _ in range(400)]
    check(spark, values, [(None, 0.0), (0.0, 0.0), (0.0, 5.0), (3.5, 20.0), (7.0, 7.0), (9.0, 2.0), (25.0, None), (None, None), (99.0, 100.0)])


def test_many_nested_intervals(spark):
    check(spark, [float(i) for i in range(120)] * 2, [(float(i), 120.0 - i) for i in range(60)] + [(None, float(i)) for i in range(0, 60, 7)])


edge = st.one_of(st.none(), st.integers(-6, 6).map(float))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(edge, min_size=1, max_size=30), st.lists(st.tuples(edge, edge), min_size=1, max_size=8))
def test_any_intervals(spark, values, intervals):
    check(spark, values, intervals)


def test_left_join_repeated_intervals_and_empty_inputs(spark):
    vs, bs = frames(spark, [1.0, 5.0, None, 50.0], [(0.0, 2.0), (0.0, 9.0)])
    got = sorted(((r.i, r.b) for r in interval_join(vs, "v", bs, "lo", "hi", "left").collect()), key=str)
    assert got == sorted([(0, 0), (0, 1), (1, 1), (2, None), (3, None)], key=str)
    twice = bs.select("lo", "hi").unionAll(bs.select("lo", "hi"))
    assert sorted((r.hi, r.n) for r in count_in_intervals(vs, "v", twice, "lo", "hi", "n").collect()) == [(2.0, 1), (2.0, 1), (9.0, 2), (9.0, 2)]
    assert [r.n for r in count_in_intervals(vs.limit(0), "v", bs, "lo", "hi", "n").collect()] == [0, 0]
    assert interval_join(vs, "v", bs.limit(0), "lo", "hi").collect() == []
    with pytest.raises(ValueError):
        interval_join(vs, "v", vs, "i", "v")


def test_the_plan_has_no_nested_loop(spark):
    vs, bs = frames(spark, [1.0, 2.0], [(0.0, 2.0)])
    for df in (count_in_intervals(vs, "v", bs, "lo", "hi", "n"), interval_join(vs, "v", bs, "lo", "hi")):
        plan = df._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
