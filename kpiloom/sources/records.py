"""CSV records with quoted line breaks, read in parallel.

A line break inside quotes does not end a record, so a task that starts in the
middle of a file cannot tell by itself where a record begins.  Here the file is
read by lines, in as many splits as its size gives.  A line is a map from the state
before it (outside or inside quotes) to the state after it.  Maps compose, so
each split is one map too: a first pass over the lines gives the maps of the splits
(one row each), a scan over the splits of a file the state at every split's start.
With it a second pass knows the state at every line, and each task puts the
records of its splits together as it reads them.  No line is shuffled: only the
pieces of records that go on from one split into the next, two a split at most, meet
afterwards, and the records are written once.

The groups that a scan needs in one task are the splits of one file; a join brings
every task the states of the splits (a number and a flag each).  ``LONGEST`` characters
bound a record: an opening quote that is never closed stops the load instead of
taking the rest of the file.
"""

from __future__ import annotations

import sys
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.session import stored

LONGEST = 64 << 20
HEADERS = 1000          # different headers among the files of one input
# fields by RFC 4180: quoted (a doubled quote is a quote; what follows the closing one belongs to the field), plain or empty
_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|(?=,|$))'
OPENS = rf'^(?:{_FIELD},)*+"{_QUOTED}$'                              # outside before, inside after
STAYS = rf'^{_QUOTED}(?:$|"[^,]*+(?:,{_FIELD})*+,"{_QUOTED}$)'       # inside before, inside after
_FILE, _SPLIT = "_kl_file", "_kl_split"
cloudpickle.register_pickle_by_value(sys.modules[__name__])      # executors need no package install
WHOLE, ON, BEGUN = 0, 1, 2      # a record; a piece that goes on from the split before; one that begins here and goes on


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines in the order of each split, with their file (by its hash, a number a line), split, and the state after
    them from outside (``o``) and inside (``i``) quotes."""
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_SPLIT), F.col("value").alias("line"))
    quotes = F.contains("line", F.lit('"'))
    return rows.withColumn("o", quotes & F.col("line").rlike(OPENS)).withColumn("i", ~quotes | F.col("line").rlike(STAYS))


@contextmanager
def _same_splits(spark: SparkSession):
    """The files are cut alike by all passes inside, however many executors come and go meanwhile."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    if before is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def after(o: np.ndarray, i: np.ndarray, start: bool) -> np.ndarray:
    """The state after each line from the state before the first.

    A map is constant, the identity or a swap; what holds after a line is the last
    constant up to it, swapped as often as swaps follow it.
    """
    swaps = np.cumsum(o & ~i)
    last = np.maximum.accumulate(np.where(o == i, np.arange(len(o)), -1))
    at = np.maximum(last, 0)
    odd = (swaps - np.where(last >= 0, swaps[at], 0)) % 2 == 1
    return np.where(last >= 0, o[at], start) != odd


def runs(batch: pa.RecordBatch):
    """((file, split), first line, end) of the splits that a batch has lines of."""
    file, split = (batch.column(k).to_numpy() for k in (0, 1))
    if len(file):
        new = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
        for a, b in zip([0, *new.tolist()], [*new.tolist(), len(file)]):
            yield (int(file[a]), int(split[a])), a, b


def split_maps(batches):
    """(file, split, o, i): the composed map of each split's lines."""
    def row():
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, *state)], names=[_FILE, _SPLIT, "o", "i"])

    key = state = None
    for batch in batches:
        o, i = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
        for now, a, b in runs(batch):
            if now != key:
                if key is not None:
                    yield row()
                key, state = now, (False, True)
            state = tuple(bool(after(o[a:b], i[a:b], s)[-1]) for s in state)
    if key is not None:
        yield row()


def assembled(batches, path, longest: int):
    """(file, split, kind, is_header, lines): the records of each split, and the pieces of those that reach beyond it."""
    def out(kind, header, offsets, lines):
        n = len(offsets) - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(np.full(n, kind, np.int32)), pa.array(header),
             pa.ListArray.from_arrays(pa.array(np.asarray(offsets, np.int32)), lines)],
            names=[_FILE, _SPLIT, "kind", "is_header", "lines"])

    def held(lines, first):
        nonlocal chars, header
        part.append(lines)
        header |= first
        chars += pc.sum(pc.utf8_length(lines)).as_py() or 0
        if chars > longest:
            raise ValueError(unclosed)

    def flush(kind):
        nonlocal part, chars, header, begun
        lines = pa.concat_arrays(part)
        made = out(kind, np.array([header]), [0, len(lines)], lines)
        part, chars, header, begun = [], 0, False, False
        return made

    unclosed = f"a quote is not closed within a record's length in {path}"
    key, state, seen = None, False, False
    part, chars, header, begun = [], 0, False, False     # the lines of a record that is open, and whether it began in this split
    for batch in batches:
        o, i, inside, filled = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4, 5))
        lines = batch.column(6)
        for now, a, b in runs(batch):
            if now != key:
                if part:
                    yield flush(BEGUN if begun else ON)
                key, seen = now, now[1] != 0             # a header stands in the first split
                if inside[a] is None:
                    raise ValueError(f"the files or their splits changed while they were read: {path}")
                state = bool(inside[a])
            ends = after(o[a:b], i[a:b], state)
            starts = np.flatnonzero(~np.append(state, ends[:-1]))
            first = -1
            if not seen and filled[a:b].any():
                first, seen = int(np.argmax(filled[a:b])), True
            state = bool(ends[-1])
            upto = int(starts[0]) if len(starts) else b - a
            if upto:                                     # the rest of a record that was open
                held(lines.slice(a, upto), 0 <= first < upto)
                if upto < b - a or not state:
                    yield flush(WHOLE if begun else ON)
            if not len(starts):
                continue
            edges = np.append(starts, b - a)
            if state:
                edges = edges[:-1]
            if len(edges) > 1:
                is_header = np.zeros(len(edges) - 1, bool)
                if edges[0] <= first < edges[-1]:
                    is_header[np.searchsorted(edges, first, side="right") - 1] = True
                whole = lines.slice(a + int(edges[0]), int(edges[-1] - edges[0]))
                if whole.nbytes > longest:
                    size = np.add.reduceat(pc.utf8_length(whole).to_numpy(), edges[:-1] - edges[0])
                    if (size[np.diff(edges) > 1] > longest).any():
                        raise ValueError(unclosed)
                yield out(WHOLE, is_header, edges - edges[0], whole)
            if state:
                begun = True
                held(lines.slice(a + int(edges[-1]), int(b - a - edges[-1])), first >= edges[-1])
    if part:
        yield flush(BEGUN if begun else ON)


def _states(rows: DataFrame, within: list[str], order: str, out: str) -> DataFrame:
    """``rows`` with the composed map of all rows before them in ``order``: (``out``_o, ``out``_i); see ``after``."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    constant, swap = F.col("o") == F.col("i"), F.col("o") & ~F.col("i")
    swaps = F.coalesce(F.sum(swap.cast("int")).over(before), F.lit(0))
    upto = rows.withColumn("_kl_s", swaps)
    last = F.last(F.when(constant, F.struct(F.col("o").alias("to"), F.col("_kl_s").alias("s"))), ignorenulls=True).over(before)
    with_last = upto.withColumn("_kl_l", last)

    def at(start: bool) -> Column:
        odd = (F.col("_kl_s") - F.coalesce(F.col("_kl_l.s"), F.lit(0))) % 2 == 1
        return F.coalesce(F.col("_kl_l.to"), F.lit(start)) != odd

    return with_last.withColumn(f"{out}_o", at(False)).withColumn(f"{out}_i", at(True)).drop("_kl_s", "_kl_l")


def _record(text: Column) -> Column:
    """A record's text without the mark before a header and the carriage return at its end."""
    return F.regexp_replace(F.when(F.col("is_header"), F.regexp_replace(text, "^\ufeff", "")).otherwise(text), "\r$", "")


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(file, is_header, record): every record of the files as text, without its line end; blank lines are left out."""
    lines, key, longest = _lines(spark, path), [_FILE, _SPLIT], LONGEST
    with _same_splits(spark):
        maps = lines.select(*key, "o", "i").mapInArrow(split_maps, f"{_FILE} long, {_SPLIT} long, o boolean, i boolean")
        starts = stored(_states(maps, [_FILE], _SPLIT, "at").select(*key, F.col("at_o").alias("_kl_in")))
        # broadcast: a shuffle would take the lines out of their order; a row of it stands for a split of the input
        known = lines.join(F.broadcast(starts), key, "left").select(
            *key, "o", "i", "_kl_in", (~F.col("line").isin("", "\r", "\ufeff")).alias("filled"), "line")
        made = known.mapInArrow(lambda batches: assembled(batches, path, longest),
                                f"{_FILE} long, {_SPLIT} long, kind int, is_header boolean, lines array<string>")
        # written: later passes read records
        whole, text = F.col("kind") == WHOLE, F.array_join("lines", "\n")
        rows = stored(made.select(*key, "kind", "is_header", F.when(whole, _record(text)).otherwise(text).alias("record"))
                      .where(~whole | (F.col("record") != "")), compression="zstd")
    pieces = rows.where(F.col("kind") != WHOLE)
    upto = Window.partitionBy(_FILE).orderBy(_SPLIT, "kind")     # in a split, what goes on comes before what begins
    pieces = pieces.withColumn("_kl_rec", F.sum((F.col("kind") == BEGUN).cast("int")).over(upto))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(_SPLIT, "kind", "record"))), lambda p: p["record"]), "\n")
    long = F.sum(F.length(F.translate("record", "\n", ""))).over(Window.partitionBy(_FILE, "_kl_rec"))
    fits = F.when(long <= LONGEST, True).otherwise(
        F.raise_error(F.lit(f"a quote is not closed within a record's length in {path}")).cast("boolean"))
    joined = stored(pieces.withColumn("fits", fits).where("fits").groupBy(_FILE, "_kl_rec")
                    .agg(F.max("is_header").alias("is_header"), text.alias("record"))
                    .select(_FILE, "is_header", _record(F.col("record")).alias("record")).where(F.col("record") != ""))
    return rows.where(F.col("kind") == WHOLE).select(_FILE, "is_header", "record").unionByName(joined).withColumnRenamed(_FILE, "file")


def split_csv(spark: SparkSession, path, options: dict[str, str], corrupt: str) -> DataFrame:
    """All columns of the CSV files as text, by the names in each file's header, plus the raw text of records with
    a wrong number of fields.  Files may have their columns in different orders; all must have the same names."""
    records = csv_records(spark, path)
    heads = stored(records.where("is_header").select("file", F.col("record").alias("_kl_head")))
    headers = heads.select(F.col("_kl_head").alias("head")).distinct().limit(HEADERS + 1).collect()
    if len(headers) > HEADERS:
        raise ValueError(f"{path}: more than {HEADERS} different headers")
    if len(headers) > 1:                # the columns stand in the order of the first file by name
        names = spark.read.format("binaryFile").load(path).select("_metadata.file_path")    # a list: no content is read
        headers = names.withColumn("file", F.xxhash64("file_path")).join(heads, "file").groupBy(F.col("_kl_head").alias("head")) \
            .agg(F.min("file_path").alias("name")).orderBy("name").collect()
    rules = {**options, "multiLine": "true", "header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    named = {h["head"]: _names(spark, h["head"], rules) for h in headers}
    if not named:
        raise ValueError(f"{path}: no header")
    first = next(iter(named.values()))
    if any(sorted(map(str.lower, n)) != sorted(map(str.lower, first)) for n in named.values()):
        raise ValueError(f"{path}: the headers have different names: {sorted(named)[:5]}")
    body = records.where("NOT is_header") if len(named) == 1 else records.where("NOT is_header").join(heads, "file")
    out = None
    for head, names in named.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(corrupt, T.StringType())])
        rows = body if len(named) == 1 else body.where(F.col("_kl_head") == head)
        # parsed once: Spark moves no check of the fields below a column that is not deterministic, where each would parse again
        fields = F.from_csv("record", _ddl(schema), rules)
        parsed = rows.select(F.when(F.monotonically_increasing_id() >= 0, fields).alias("r"))
        low = {n.lower(): n for n in names}
        part = parsed.select(*[F.col("r").getField(low[n.lower()]).alias(n) for n in first], F.col("r").getField(corrupt).alias(corrupt))
        out = part if out is None else out.unionByName(part)
    return out


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


def _names(spark: SparkSession, head: str, rules: dict[str, str]) -> list[str]:
    """The fields of a header line."""
    n = head.count(",") + 1
    row = spark.range(1).select(F.from_csv(F.lit(head), ", ".join(f"c{k} string" for k in range(n)), rules).alias("r")).first()[0]
    names = [c.strip() for c in row if c is not None]
    if len(set(map(str.lower, names))) != len(names):
        raise ValueError(f"a name stands twice in the header: {head}")
    return names
