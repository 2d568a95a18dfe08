"""CSV columns with inferred types, by the rules of R's ``read.csv``.

Every text value is a set of kinds it could be (a bit each); the set of a column is
the intersection over its values, so inference is one ``bit_and`` per column:
one pass, mergeable, the same however rows are spread over tasks and files.  The
column's type is the first kind left, in the order of ``KINDS``; text is always
left.  A single late value is enough to widen a column.

Fixed rules: ``NA`` is missing everywhere; a blank field is missing in logical and
number columns and the empty string in text.  Logicals are T, F, TRUE, FALSE,
true and false.  Whole numbers beyond 32 bits are doubles, as in R, or longs with
``wide``.  A column without values is logical.  Dates stay text, as in R, or
become dates and timestamps with ``dates``, by the first form that fits all values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.sources.files import CORRUPT, csv_options, split_file_rows

NA = "NA"
LOGICAL_TRUE, LOGICAL_FALSE = ("T", "TRUE", "true"), ("F", "FALSE", "false")
# date forms (Spark pattern, shape), the first that fits every value wins; a shape leaves out months, days and
# times that do not exist, so that the dear parser sees few values it refuses
_M, _D, _H = r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])", r"(?:[01]?\d|2[0-3]):[0-5]\d"
_ISO = r"\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])"
DATE_FORMS = (("yyyy-MM-dd", rf"^{_ISO}$"), ("M/d/yyyy", rf"^{_M}/{_D}/\d{{4}}$"), ("d/M/yyyy", rf"^{_D}/{_M}/\d{{4}}$"),
              ("yyyy-MM-dd HH:mm:ss", rf"^{_ISO} (?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d$"),
              ("M/d/yyyy H:mm", rf"^{_M}/{_D}/\d{{4}} {_H}$"), ("d/M/yyyy H:mm", rf"^{_D}/{_M}/\d{{4}} {_H}$"))
KINDS = ("logical", "integer", "whole", "real", *[f for f, _ in DATE_FORMS], "text")
WHOLE = r"^\s*[+-]?\d+\s*$"
REAL = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$|^\s*(?:NaN|[+-]?Inf)\s*$"


def _bit(kind: str) -> int:
    return 1 << KINDS.index(kind)


def kinds_of(value: Column) -> Column:
    """The kinds a value could be, as bits; all kinds for a missing or blank one."""
    every = (1 << len(KINDS)) - 1
    number = F.trim(value)
    integer = number.try_cast("long").between(-(2**31 - 1), 2**31 - 1)
    numeric = F.when(value.rlike(WHOLE), F.when(integer, _bit("integer") | _bit("whole") | _bit("real"))
                     .when(number.try_cast("long").isNotNull(), _bit("whole") | _bit("real")).otherwise(_bit("real"))) \
        .when(value.rlike(REAL), _bit("real")).otherwise(0)
    dates = F.lit(0)
    for form, shape in DATE_FORMS:
        fits = value.rlike(shape) & F.try_to_timestamp(value, F.lit(form)).isNotNull()
        dates = dates.bitwiseOR(F.when(fits, _bit(form)).otherwise(0))
    some_date = F.when(value.rlike(r"^\d{1,4}[-/]"), dates).otherwise(0)
    logical = F.when(value.isin(*LOGICAL_TRUE, *LOGICAL_FALSE), _bit("logical")).otherwise(0)
    known = F.lit(_bit("text")).bitwiseOR(F.when(value.rlike(r"^\s*[\d+.\-NI]"), numeric.bitwiseOR(some_date)).otherwise(logical))
    # short plain numbers, the commonest values, take one test
    plain = _bit("integer") | _bit("whole") | _bit("real") | _bit("text")
    return F.when(value.rlike(r"^[0-9]{1,9}\z"), plain) \
        .when(value.isNull() | (value == NA) | (F.trim(value) == ""), F.lit(every)).otherwise(known)


def infer_types(text: DataFrame, wide: bool = False, dates: bool = False) -> DataFrame:
    """(position, name, type, form, n_missing) of every text column; ``form`` is the date form, if all values have one.

    ``n_missing`` counts what the typed column holds as NULL.
    """
    names = [c for c in text.columns if c != CORRUPT]
    # a row per value: one expression for all columns, small enough to be compiled
    each = F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"`{n}`").alias("v")) for i, n in enumerate(names)])
    v = F.col("x.v")
    absent = v.isNull() | (v == NA)
    folded = text.select(F.explode(each).alias("x")).groupBy(F.col("x.position").alias("position")).agg(
        F.bit_and(kinds_of(v)).alias("kinds"), F.count(F.when(absent, 1)).alias("absent"),
        F.count(F.when(~absent & (F.trim(v) == ""), 1)).alias("blank"), F.count(F.lit(1)).alias("rows"))
    columns = text.sparkSession.range(len(names)).select(
        F.col("id").cast("int").alias("position"), F.element_at(F.array(*[F.lit(n) for n in names]), F.col("id").cast("int") + 1).alias("name"))
    one = columns.join(folded, "position", "left").na.fill(0, ["absent", "blank", "rows"])     # no rows: no value of any column
    has = lambda kind: F.col("kinds").bitwiseAND(F.lit(_bit(kind))) != 0
    form = F.coalesce(*[F.when(has(f), F.lit(f)) for f, _ in DATE_FORMS])
    valued = F.col("rows") > F.col("absent") + F.col("blank")
    kind = F.when(~valued | has("logical"), "boolean").when(has("integer"), "int") \
        .when(has("whole"), "bigint" if wide else "double").when(has("real"), "double")
    if dates:
        timed = [f for f, _ in DATE_FORMS if "H" in f]
        kind = kind.when(form.isin(timed), "timestamp").when(form.isNotNull(), "date")
    typed = one.withColumn("type", kind.otherwise("string")).withColumn("form", F.when(valued, form))
    return typed.select("position", "name", "type", "form",
                        (F.col("absent") + F.when(F.col("type") == "string", 0).otherwise(F.col("blank"))).cast("bigint").alias("n_missing"))


def with_types(text: DataFrame, types: list) -> DataFrame:
    """The text columns in the types of ``infer_types`` rows."""
    out = []
    for t in types:
        value = F.col(f"`{t['name']}`")
        value = F.when(value != NA, value)
        if t["type"] == "boolean":
            value = F.when(value.isin(*LOGICAL_TRUE), True).when(value.isin(*LOGICAL_FALSE), False)
        elif t["type"] in ("date", "timestamp"):
            value = F.try_to_timestamp(value, F.lit(t["form"])).cast(t["type"])
        elif t["type"] != "string":
            value = F.trim(value).try_cast(t["type"])
        out.append(value.alias(t["name"]))
    return text.select(*out)


def text_columns(spark: SparkSession, path, multi_line: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """All columns of the CSV as text; a record with a wrong number of fields stops the job.

    With ``multi_line``, records may hold quoted line breaks and the files may
    order their columns differently; without, all files have the first one's header.
    A blank field is the empty string.
    """
    rows = split_file_rows(spark, path, csv_options(multi_line, encoding), multi_line, encoding)
    # names a field too: Spark does not read the raw record alone
    message = F.concat_ws(" ", F.lit("a CSV record has a wrong number of fields:"), F.col(CORRUPT), F.col(f"`{rows.columns[0]}`"))
    checked = rows.where(F.when(F.col(CORRUPT).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return checked.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns if c != CORRUPT])


def load_csv(spark: SparkSession, path, *, multi_line: bool = False, encoding: str = "UTF-8", wide: bool = False,
             dates: bool = False) -> DataFrame:
    """S1, S2 without a schema: any CSV with a header, its columns typed by their values."""
    text = text_columns(spark, path, multi_line, encoding)
    return with_types(text, infer_types(text, wide, dates).orderBy("position").collect())    # a row per column
