"""In-place updates: what is rewritten, what a dead run leaves, versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiloom.sources import updates

ROWS = [(i, dt.date(2000 + i % 4, 1, 1 + i % 28), "" if i % 4 == 2 and i % 3 == 0 else f"x{i}") for i in range(80)]


@pytest.fixture
def root(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id int, d date, name string").withColumn("y", F.year("d"))
    updates.create_table(df, str(tmp_path / "t"), "y", "d")
    return str(tmp_path / "t")


def held(spark, root, number=None):
    return sorted((r.id, r.name) for r in updates.read_version(spark, root, number).collect())


def folders(spark, root, number):
    return updates._manifest(spark, root, number)["folders"]


def test_a_correction_in_one_year_rewrites_one_folder(spark, root):
    before = folders(spark, root, 1)
    assert len(before) == 4
    assert updates.update_table(spark, root, {"name": F.lit("none")}, F.col("name") == "") == 1
    after = folders(spark, root, 2)
    assert [k for k in before if before[k] != after[k]] == ["y=2002"] and set(after) == set(before)
    assert held(spark, root) == sorted((i, n or "none") for i, _, n in ROWS)
    assert held(spark, root, 1) == sorted((i, n) for i, _, n in ROWS)       # a reader of the old version goes on
    assert updates.read_version(spark, root).schema == updates.read_version(spark, root, 1).schema


def test_a_dead_run_leaves_the_old_table(spark, root, monkeypatch):
    def die(*_):
        raise KeyboardInterrupt
    for step in ("_commit", "_store"):
        with monkeypatch.context() as m:
            m.setattr(updates, step, die)
            with pytest.raises(KeyboardInterrupt):
                updates.update_table(spark, root, {"name": F.upper("name")}, F.lit(True))
        assert updates.version(spark, root) == 1 and held(spark, root) == sorted((i, n) for i, _, n in ROWS)
    assert updates.update_table(spark, root, {"name": F.upper("name")}, F.col("id") < 8) == 4
    assert updates.forget_versions(spark, root) == 8        # four of version 1, four of the dead run
    assert held(spark, root) == sorted((i, n.upper() if i < 8 else n) for i, _, n in ROWS)


def test_nothing_to_change_null_conditions_and_conflicts(spark, root):
    assert updates.update_table(spark, root, {"name": F.lit("z")}, F.lit(None).cast("boolean")) == 0
    assert updates.version(spark, root) == 1
    with pytest.raises(RuntimeError, match="another run"):
        updates._commit(spark, root, 1, updates._manifest(spark, root, 1))
    with pytest.raises(ValueError):
        updates.update_table(spark, root, {"y": F.lit(1)}, F.lit(True))
    with pytest.raises(ValueError):
        updates.create_table(updates.read_version(spark, root), root, "y")
    with pytest.raises(ValueError):
        updates.read_version(spark, root + "x")


def test_filters_prune_folders(spark, root):
    updates.update_table(spark, root, {"name": F.lit("q")}, F.col("y") == 2001)
    plan = updates.read_version(spark, root).where("y = 2001")._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "2001" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_rows_without_a_partition_value(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, "b")], "id int, y int, name string")
    updates.create_table(df, str(tmp_path / "n"), "y")
    assert updates.update_table(spark, str(tmp_path / "n"), {"name": F.lit("c")}, F.col("id") == 1) == 1
    assert sorted(map(str, updates.read_version(spark, str(tmp_path / "n")).collect())) == [
        "Row(id=1, y=None, name='c')", "Row(id=2, y=5, name='b')"]


def test_an_update_shuffles_no_rows(spark, tmp_path, monkeypatch):
    """the partitions are written anew by the tasks that read them."""
    seen = []
    store = updates._store
    monkeypatch.setattr(updates, "_store", lambda rows, *a, **k: (seen.append(rows), store(rows, *a, **k))[1])
    hints = []
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, name, *c: (hints.append(name), self)[1])
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(k, k % 3, "a") for k in range(30)], "k int, year int, name string").repartition(4)
    updates.create_table(rows, root, "year", "k")
    assert hints == ["rebalance"]
    assert updates.update_table(spark, root, {"name": F.lit("b")}, F.col("k") < 5) == 3
    assert hints == ["rebalance"] and len(seen) == 2
    got = {r.k: r.name for r in updates.read_version(spark, root).collect()}
    assert got == {k: "b" if k < 5 else "a" for k in range(30)}


def test_the_test_for_normalised_text_agrees_with_the_rule(spark):
    """the search for rows to change builds no new text for plain ones."""
    import random
    from kpiloom.operators.cleaning import normalised, unnormalised
    rnd = random.Random(7)
    values = [None, "", " ", "Ab-Cd 3x", "A\n", "A\tb", "\u00df", "Stra\u00dfe", "\u01c6x", "\u00c9T\u00c9", "Z "] + [
        "".join(rnd.choice("abXY09 -'_\u00e9\u00c9\n") for _ in range(rnd.randrange(1, 7))) for _ in range(3000)] + [
        "".join(rnd.choice("abXY09 -.") for _ in range(rnd.randrange(1, 5))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    assert df.where(unnormalised("c") != ~F.col("c").eqNullSafe(normalised("c"))).collect() == []
    assert df.where(unnormalised("c").isNull()).count() == 0 and 0 < df.where(unnormalised("c")).count() < df.count()
