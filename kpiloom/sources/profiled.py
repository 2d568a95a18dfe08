"""Profiling figures taken while a table is written (F2, F4, F5 without a scan).

``write_profiled`` counts the rows and each column's values and keeps the range
of the date columns as observed metrics of the write itself, in the tasks that
write the files: such a task counts once however often it is repeated, while
a task before a shuffle would count again after a lost executor.  The figures
stand beside the files with a fingerprint of them (names, sizes, times).  The
readers below use the figures only while the fingerprint matches the files;
a table that was changed since, or written otherwise, is scanned.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators import profile
from kpiloom.session import hadoop_path, input_files
from kpiloom.sources.files import write_table

FIGURES = "_kpiloom_profile"


def _measures(df: DataFrame) -> tuple[list[Column], list[str]]:
    """The observed metrics (m0 the rows, then one per column, then two per date column) and the date columns."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    column = lambda c: F.col("`" + c.replace("`", "``") + "`")
    found = [F.count(F.lit(1)), *[F.count(column(c)) for c in df.columns]]
    for c in dates:
        found += [F.min(column(c)), F.max(column(c))]
    return [m.alias(f"m{i}") for i, m in enumerate(found)], dates


def _fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the data files of a table."""
    root = hadoop_path(spark, path)[1].toUri().getPath().rstrip("/")
    files = sorted((name.split(root, 1)[-1], size, time) for name, size, time in input_files(spark, [path])
                   if not name.rsplit("/", 1)[-1].startswith(("_", ".")))
    return hashlib.sha256(json.dumps(files).encode()).hexdigest()


def write_profiled(df: DataFrame, path: str, **layout) -> DataFrame:
    """``write_table`` that leaves the table's figures beside its files."""
    spark, path = df.sparkSession, path.rstrip("/")
    measures, dates = _measures(df)
    seen = Observation()
    table = write_table(df, path, observe=(seen, measures), **layout)
    rows, *rest = (seen.get[f"m{i}"] for i in range(len(measures)))
    bounds = [None if v is None else v.isoformat() for v in rest[len(df.columns):]]
    figures = {"rows": rows, "values": dict(zip(df.columns, rest)),
               "dates": {c: bounds[2 * i:2 * i + 2] for i, c in enumerate(dates)}, "files": _fingerprint(spark, path)}
    fs, where = hadoop_path(spark, f"{path}/{FIGURES}")
    out = fs.create(where, True)
    out.write(bytearray(json.dumps(figures).encode()))
    out.close()
    return table


def figures_of(spark: SparkSession, path: str) -> dict | None:
    """The stored figures of the table at ``path``; None if there are none or its files changed since."""
    path = path.rstrip("/")
    fs, where = hadoop_path(spark, f"{path}/{FIGURES}")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        figures = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return figures if figures["files"] == _fingerprint(spark, path) else None


def non_null_counts(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """F2 of a stored table."""
    figures = figures_of(spark, path)
    if figures is None:
        return profile.non_null_counts(spark.read.parquet(path), cols)
    cols = list(cols) if cols else [c for c in profile.NON_NULL_NAMES if c in figures["values"]]
    names = [profile.NON_NULL_NAMES.get(c, f"{c.lower()}_not_null_count") for c in cols]
    counts = [figures["values"][c] if figures["rows"] else None for c in cols]      # as SUM over no rows
    return spark.createDataFrame([counts], T.StructType([T.StructField(n, T.LongType()) for n in names]))


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """F4 of a stored table."""
    figures = figures_of(spark, path)
    if figures is None:
        return profile.row_count(spark.read.parquet(path))
    return spark.createDataFrame([(figures["rows"],)], "n bigint")


def date_range(spark: SparkSession, path: str, col: str = "visit_date") -> DataFrame:
    """F5 of a stored table."""
    figures = figures_of(spark, path)
    if figures is None or col not in figures["dates"]:
        return profile.date_range(spark.read.parquet(path), col)
    bounds = [None if x is None else dt.date.fromisoformat(x) for x in figures["dates"][col]]
    return spark.createDataFrame([bounds], "min_date date, max_date date")
