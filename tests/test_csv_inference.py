"""Inferred CSV types and records with quoted line breaks over several splits."""

import random

import numpy as np
import pytest

from kpiloom.sources import records
from kpiloom.sources.files import CORRUPT, QUOTING, csv_options, load_sales
from kpiloom.sources.infer import infer_types, load_csv, text_columns


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(path, text):
    path.parent.mkdir(exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def invented(seed, n):
    rnd = random.Random(seed)

    def field():
        k = rnd.random()
        if k < .3:
            return str(rnd.randrange(1000))
        if k < .5:
            return 'a"b c'           # a quote inside a plain field opens nothing
        return '"' + "".join(rnd.choice(["x", '""', ",", "\n", "\r\n", " ", "é", "\n\n", 'y"",""']) for _ in range(rnd.randrange(9))) + '"'
    return 'A,"b ""q""",C\n' + "".join(f"{i},{field()},{field()}\n" + "\n" * (rnd.random() < .02) for i in range(n))


def test_split_reader_equals_the_multi_line_reader(spark, small_splits, tmp_path):
    path = write(tmp_path / "f.csv", invented(1, 700))
    got = records.split_csv(spark, path, QUOTING, CORRUPT)
    assert spark.read.text(path).rdd.getNumPartitions() >= 5
    schema = ", ".join(f"`{c}` string" for c in got.columns)
    whole = spark.read.schema(schema).options(**csv_options(True)).csv(path)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_no_task_holds_a_whole_file(spark, small_splits, tmp_path):
    path = write(tmp_path / "f.csv", invented(2, 700))
    lines = records._lines(spark, path)
    per_split = [r["count"] for r in lines.groupBy(records._SPLIT).count().collect()]
    assert len(per_split) >= 5 and max(per_split) <= sum(per_split) / 3


def test_a_record_longer_than_several_splits(spark, small_splits, tmp_path):
    body = "line with, commas\n" * 600
    path = write(tmp_path / "f.csv", f'a,b\n1,"{body}"\n2,x\n3,"{body}y"\n')
    got = load_csv(spark, path, multi_line=True)
    assert sorted(map(tuple, got.collect())) == [(1, body), (2, "x"), (3, body + "y")]


def test_line_ends_and_headers_in_any_order(spark, tmp_path):
    write(tmp_path / "in" / "1.csv", '\ufeffa,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n')
    write(tmp_path / "in" / "2.csv", 'B,A\n"q, ""r""\ns",3')
    got = load_csv(spark, str(tmp_path / "in"), multi_line=True)
    assert sorted(map(tuple, got.collect())) == [(1, "x\r\ny"), (2, "z"), (3, 'q, "r"\ns')]


def test_records_across_batches_splits_and_files(spark, small_splits, tmp_path):
    """A record goes on over many Arrow batches, a batch holds lines of several splits, and headers differ in order."""
    write(tmp_path / "in" / "1.csv", invented(3, 300))
    write(tmp_path / "in" / "2.csv", 'C,"b ""q""",A\n' + "".join(f'z{i},"{chr(10) * (i % 40)}\u00e9",{i}\n' for i in range(400)))
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        got = records.split_csv(spark, str(tmp_path / "in"), QUOTING, CORRUPT).select("A", 'b "q"', "C", CORRUPT)
        rows = sorted(map(str, got.collect()))
    finally:
        spark.conf.set(name, before)
    whole = [spark.read.schema(", ".join(f"`{c}` string" for c in names)).options(**csv_options(True)).csv(str(tmp_path / "in" / f))
             .select(*got.columns) for f, names in (("1.csv", got.columns), ("2.csv", ["C", 'b "q"', "A", CORRUPT]))]
    assert rows == sorted(map(str, whole[0].union(whole[1]).collect()))


def test_states_compose_as_line_by_line():
    rnd = random.Random(4)
    for n in (1, 2, 30):
        for start in (False, True):
            o, i = (np.array([rnd.random() < .5 for _ in range(n)]) for _ in range(2))
            state, want = start, []
            for x, y in zip(o, i):
                state = bool(y if state else x)
                want.append(state)
            assert records.after(o, i, start).tolist() == want


def test_no_line_is_shuffled_and_a_record_is_parsed_once(spark, small_splits, tmp_path, monkeypatch):
    """tasks put records together as they read the lines; only the maps of the splits and pieces of records are shuffled."""
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    path = write(tmp_path / "s.csv", header + 'C1,2,"two\nlines ""x""",3,1/2/2011 8:00,1.5,17850,UK\n' * 300)
    plans, plain = [], records.stored
    explained = lambda df: df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    monkeypatch.setattr(records, "stored", lambda df, **k: plans.append(explained(df)) or plain(df, **k))
    rows = load_sales(spark, path, multi_line=True)
    read = [p for p in plans if "Scan text" in p]
    assert read and not any(") Exchange" in b and "line" in b for p in read for b in p.split("\n\n"))
    checks = [b for b in explained(rows).split("\n\n") if "Condition" in b]
    assert checks and not any("from_csv" in b for b in checks)
    assert rows.count() == 300 and rows.first().Description == 'two\nlines "x"'


def test_an_open_quote_stops_the_load(spark, small_splits, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "LONGEST", 3000)
    path = write(tmp_path / "f.csv", 'a,b\n1,"open\n' + "2,x\n" * 2000)
    with pytest.raises(Exception, match="a quote is not closed"):
        records.split_csv(spark, path, QUOTING, CORRUPT).collect()
    with pytest.raises(ValueError, match="no header"):
        records.split_csv(spark, write(tmp_path / "e.csv", "\n"), QUOTING, CORRUPT)
    with pytest.raises(ValueError, match="different names"):
        write(tmp_path / "two" / "1.csv", "a,b\n1,2\n")
        write(tmp_path / "two" / "2.csv", "a,c\n1,2\n")
        records.split_csv(spark, str(tmp_path / "two"), QUOTING, CORRUPT)


@pytest.mark.parametrize("values,kind,form", [
    (["1", " 22 ", "", "NA"], "int", None), (["1", "2147483648"], "double", None), (["1", "2.5e3"], "double", None),
    (["T", "false", "NA"], "boolean", None), (["T", "1"], "string", None), (["", "NA"], "boolean", None),
    (["1", "x"], "string", None), (["-.5", "Inf", "NaN"], "double", None), (["2011-02-03", "2011-02-30"], "string", None),
    (["2011-02-03", ""], "string", "yyyy-MM-dd"), (["1/2/2011", "12/13/2011"], "string", "M/d/yyyy"),
    (["1/2/2011", "13/12/2011"], "string", "d/M/yyyy"), (["12/1/2010 8:26"], "string", "M/d/yyyy H:mm"),
    (["1/2/2011", "1/2/2011 1:00"], "string", None), (["1e5", "1d"], "string", None)])
def test_types_follow_the_rules(spark, values, kind, form):
    df = spark.createDataFrame([(v,) for v in values], "c string").repartition(3)
    got = infer_types(df).first()
    assert (got.type, got.form) == (kind, form)


def test_a_late_value_in_a_second_file_widens_the_column(spark, tmp_path):
    write(tmp_path / "in" / "1.csv", "id,n,day\n" + "1,2,2011-01-02\n" * 500)
    write(tmp_path / "in" / "2.csv", "id,n,day\n9,2.5,2011-01-03\nA9,NA,2011-01-04\n")
    got = load_csv(spark, str(tmp_path / "in"), dates=True)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema.fields] == [("id", "string"), ("n", "double"), ("day", "date")]
    assert got.where("n IS NULL").count() == 1 and got.count() == 502
    only = load_csv(spark, str(tmp_path / "in" / "1.csv"), wide=True)
    assert [f.dataType.simpleString() for f in only.schema.fields] == ["int", "int", "string"]


def test_missing_values_and_wide_numbers(spark, tmp_path):
    path = write(tmp_path / "f.csv", 'a,b,c\nNA,,3000000000\n"NA",x,\n')
    text = text_columns(spark, path)
    types = {r["name"]: (r["type"], r["n_missing"]) for r in infer_types(text, wide=True).collect()}
    assert types == {"a": ("boolean", 2), "b": ("string", 0), "c": ("bigint", 1)}
    assert sorted(map(str, load_csv(spark, path, wide=True).collect())) == [
        "Row(a=None, b='', c=3000000000)", "Row(a=None, b='x', c=None)"]


def test_sales_with_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "s.csv", "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                 'C1,2,"two\nlines ""x""",3,1/2/2011 8:00,1.5,17850,UK\n')
    assert [r.Description for r in load_sales(spark, path, multi_line=True).collect()] == ['two\nlines "x"']


def test_inference_is_one_expression_for_all_columns(spark):
    """The size of the plan does not grow with the columns, and impossible dates never reach the parser."""
    from kpiloom.sources.infer import DATE_FORMS
    import re
    forms = dict(DATE_FORMS)
    assert not re.match(forms["d/M/yyyy H:mm"], "12/13/2010 8:26") and not re.match(forms["M/d/yyyy"], "13/12/2011")
    assert re.match(forms["M/d/yyyy H:mm"], "12/13/2010 23:59") and not re.match(forms["yyyy-MM-dd"], "2011-13-02")
    wide = spark.createDataFrame([("1", "x", "2011-01-02")], "a string, b string, c string")
    out = infer_types(wide)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("bit_and(") == 1
    assert [(r.name, r.type, r.form) for r in out.orderBy("position").collect()] == [
        ("a", "int", None), ("b", "string", None), ("c", "string", "yyyy-MM-dd")]
    assert [(r.type, r.form, r.n_missing) for r in infer_types(wide.where("false")).collect()] == [("boolean", None, 0)] * 3
