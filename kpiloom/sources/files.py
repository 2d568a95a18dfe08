"""CSV ingest with fixed schemas, and the table sink.

Columns are matched by the names in the header, whatever their order; every
file's header is checked against the first one's.  All fields are read as
text and converted by rules of their own, so a value that does not fit never
becomes NULL without a word: the load stops, or (``split_sales``,
``split_visits``) the record goes to a reject table with its reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.schema import SALES_CSV, VISITS_CSV
from kpiloom.sources.records import split_csv

# RFC 4180 quoting, as R's read.csv writes and reads it: a quote inside a
# quoted field is doubled.
QUOTING = {"quote": '"', "escape": '"'}
MISSING = ("", "na", "nan", "null")    # fixed values: spellings of a missing number, any case
CORRUPT = "_corrupt"


def csv_options(multi_line: bool = False, encoding: str = "UTF-8") -> dict[str, str]:
    """Reader options.  ``multi_line`` accepts quoted line breaks; Spark's own reader then takes a
    file in one task, ``records.split_csv`` splits it."""
    return {"header": "true", **QUOTING, "mode": "PERMISSIVE", "enforceSchema": "false", "encoding": encoding,
            "multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": CORRUPT}


def read_text_csv(spark: SparkSession, path, names: list[str], multi_line: bool = False,
                  encoding: str = "UTF-8") -> DataFrame:
    """The named columns of a CSV as text, found by header name, plus the raw
    text of records with too few or too many fields (``_corrupt``)."""
    rows = split_file_rows(spark, path, csv_options(multi_line, encoding), multi_line, encoding)
    found = [c for c in rows.columns if c != CORRUPT]
    by_name = {c.strip().lstrip("\ufeff").lower(): c for c in found}
    lost = [n for n in names if n.lower() not in by_name]
    if lost:
        raise ValueError(f"{path}: the header has no column {', '.join(lost)}; it has {', '.join(found)}")
    return rows.select(*[F.col(f"`{by_name[n.lower()]}`").alias(n) for n in names], CORRUPT)


def split_file_rows(spark: SparkSession, path, options: dict[str, str], multi_line: bool, encoding: str) -> DataFrame:
    """All columns as text plus ``_corrupt``, large files read by several tasks.

    Line breaks inside quotes are resolved over the splits of a file (UTF-8; a
    file of another encoding with such breaks is one task).
    """
    if multi_line and encoding.upper().replace("-", "") == "UTF8":
        return split_csv(spark, path, QUOTING, CORRUPT)
    found = spark.read.options(**options).csv(path).columns          # reads one header line
    schema = T.StructType([T.StructField(c, T.StringType()) for c in found] + [T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).options(**options).csv(path)


def missing(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*MISSING)


def whole_number(c: Column, kind: str) -> tuple[Column, Column]:
    """(value, bad): integer text, with an optional fraction of zeros; anything else is bad."""
    text = F.trim(c)
    # nearly every value: so few digits that it fits, tested once instead of taken apart
    plain = text.rlike(rf"^[+-]?[0-9]{{1,{18 if kind == 'bigint' else 9}}}\z") if kind in ("int", "bigint") else F.lit(False)
    digits = F.regexp_extract(text, r"^([+-]?[0-9]+)(\.0*)?$", 1)
    value = F.when(plain, text.try_cast(kind)).otherwise(F.when(digits != "", digits.try_cast(kind)))
    return value, ~(plain | missing(c) | value.isNotNull())


def real_number(c: Column) -> tuple[Column, Column]:
    text = F.trim(c)
    plain = text.rlike(r"^[+-]?[0-9]{1,15}(\.[0-9]{1,15})?\z")
    value = F.when(plain | ~missing(c), text.try_cast("double"))
    return value, ~(plain | missing(c) | (value.isNotNull() & ~F.isnan(value)))


def iso_date(c: Column) -> tuple[Column, Column]:
    value = F.when(~missing(c), F.trim(c).try_cast("date"))
    return value, ~missing(c) & value.isNull()


def typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the schema's types, plus ``_reason``: why a record is bad, else NULL.

    Blank text fields are the empty string (the cleaning step tests it); a
    blank number or date, NA, NaN or NULL is NULL."""
    values, reasons = [], [F.when(F.col(CORRUPT).isNotNull(), F.lit("number of fields"))] if CORRUPT in rows.columns else []
    for f in schema.fields:
        c, kind = F.col(f.name), f.dataType.simpleString()
        if kind == "string":
            values.append(F.coalesce(c, F.lit("")).alias(f.name))
            continue
        value, bad = iso_date(c) if kind == "date" else real_number(c) if kind == "double" else whole_number(c, kind)
        values.append(value.alias(f.name))
        reasons.append(F.when(bad, F.concat(F.lit(f"{f.name}: "), c)))
    return rows.select(*values, F.coalesce(*reasons).alias("_reason"), *[c for c in (CORRUPT,) if c in rows.columns])


def only_good(rows: DataFrame) -> DataFrame:
    """The records of ``typed``; a bad one stops the job with its reason."""
    message = F.concat(F.lit("bad CSV record, "), F.col("_reason"))
    return rows.where(F.when(F.col("_reason").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))) \
        .drop("_reason", CORRUPT)


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected records with their reason)."""
    return rows.where(F.col("_reason").isNull()).drop("_reason", CORRUPT), rows.where(F.col("_reason").isNotNull())


def typed_sales(df: DataFrame) -> DataFrame:
    """Raw CSV columns to the fixed retail schema; a bad value stops the job."""
    return only_good(typed(df, SALES_CSV))


def load_sales(spark: SparkSession, path, *, multi_line: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """S1 read side: retail CSV with a header, fixed schema; a bad record stops the job."""
    names = [f.name for f in SALES_CSV.fields]
    return typed_sales(read_text_csv(spark, path, names, multi_line, encoding))


def split_sales(spark: SparkSession, path, *, multi_line: bool = False,
                encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    """(good lines, rejected lines with ``_reason``), to be written and counted apart."""
    names = [f.name for f in SALES_CSV.fields]
    return split(typed(read_text_csv(spark, path, names, multi_line, encoding), SALES_CSV))


def load_visits(spark: SparkSession, path, *, multi_line: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """Experiment CSV with a header; visit_date typed as date; a bad record stops the job."""
    names = [f.name for f in VISITS_CSV.fields]
    return only_good(typed(read_text_csv(spark, path, names, multi_line, encoding), VISITS_CSV))


def split_visits(spark: SparkSession, path, *, multi_line: bool = False,
                 encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame]:
    names = [f.name for f in VISITS_CSV.fields]
    return split(typed(read_text_csv(spark, path, names, multi_line, encoding), VISITS_CSV))


def write_csv(df: DataFrame, path: str) -> None:
    """Write with a header, quoted as the loaders read; blanks at the ends of a field are kept."""
    df.write.mode("overwrite").options(header="true", ignoreLeadingWhiteSpace="false",
                                       ignoreTrailingWhiteSpace="false", **QUOTING).csv(path)


def write_table(df: DataFrame, path: str, *, cluster_by: str | None = None,
                partition_by: str | None = None, rebalance: bool = True, mode: str = "overwrite",
                observe: tuple[Observation, Sequence[Column]] | None = None) -> DataFrame:
    """S1 write side: store as Parquet and return the stored table.

    ``cluster_by`` sorts each task's rows on that column before writing, so
    every Parquet row group covers a narrow range and later filters on the
    column skip row groups by their min/max statistics.  The sort is local
    (no shuffle, spills to disk), so it costs no extra pass over the input.
    ``partition_by`` writes one folder per value.  A ``rebalance`` hint on
    that column first lets AQE cut the rows into advisory-size tasks that each
    hold one value (a value with a third of the rows is split, not given to
    one task), so the table gets files of a useful size rather than one
    small file per value from every upstream task.  The sort then puts that
    column first, and the rows stay in ``cluster_by`` order inside it.
    ``rebalance=False`` leaves that shuffle of whole rows out, for rows that come
    from a large join: its tasks have the advisory size already, and each
    writes one file per value.
    ``observe`` gives metrics to take of the rows in the tasks that write them.
    """
    keys = [c for c in (partition_by, cluster_by) if c]
    out = df.hint("rebalance", partition_by) if partition_by and rebalance else df
    out = out.observe(observe[0], *observe[1]) if observe else out
    out = out.sortWithinPartitions(*keys) if keys else out
    w = out.write.mode(mode)
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.parquet(path)
