"""Spark helpers of the training-data operators: sizing, stored intermediate tables, packed rows."""

from __future__ import annotations

import struct
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.llm.arrays import mix
from kpiloom.session import checkpoint_dir

LAST = 2**63 - 1           # stands for a null id: after every other


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session, which its owner sizes to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, records_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files.  The folder is removed
    when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/kpiloom-llm-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", records_per_file).parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let the driver drop what finished steps left: Spark frees their broadcasts, shuffle files and
    metrics once the driver's memory is collected, which by itself happens late in a long row of small jobs."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """At most so many rows in an Arrow batch of what runs inside (for rows that may be large)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, made longer until no column of ``df`` has them (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered_copies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``copy``, 0.. within equal keys; a key held by many rows is numbered by partition, in no one task."""
    kept = stored(rows.withColumn("at", F.monotonically_increasing_id())).withColumn("part", F.shiftright("at", 33))
    here = kept.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy(*keys).orderBy("part")
    before = here.select(*keys, "part", (F.sum("c").over(order) - F.col("c")).alias("before"))
    own = F.row_number().over(Window.partitionBy(*keys, "part").orderBy("at")) - 1
    return kept.withColumn("own", own).join(before, [*keys, "part"]).withColumn("copy", F.col("own") + F.col("before")) \
        .drop("at", "part", "own", "before")


def key_columns(df: DataFrame, id_col: str, text_col: str) -> dict[str, Column]:
    """``id``: the id as a never-null long (null, like ``LAST`` itself, orders after
    all others and returns as null); ``variant``: a hash of the text, which tells
    rows apart that share an id."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    return {"id": F.coalesce(df[id_col].cast("long"), F.lit(LAST)), "variant": F.xxhash64(text)}


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, variant) of every row, see ``key_columns``; null text is the empty text."""
    key = key_columns(df, id_col, text_col)
    return df.select(key["id"].alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"),
                     key["variant"].alias("variant"))


def original_id(df: DataFrame, id_col: str) -> Column:
    """The column ``id`` of ``keyed`` in its first form."""
    return F.nullif("id", F.lit(LAST)).cast(df.schema[id_col].dataType).alias(id_col)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    parts = [struct.pack("<I", len(arrays))]
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
        parts += [struct.pack("<4sQQ", a.dtype.str[1:].encode(), len(raw), len(small)), small]
    return b"".join(parts)


def unpack(block: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<I", block), 4, []
    for _ in range(n):
        kind, raw, small = struct.unpack_from("<4sQQ", block, at)
        at += 20
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        if raw:
            body = pa.decompress(block[at:at + small], decompressed_size=raw, codec="zstd", asbytes=True)
            out.append(np.frombuffer(body, dtype))
        else:
            out.append(np.zeros(0, dtype))
        at += small
    return out


def join_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The arrays of several blocks, each joined over the blocks."""
    rows = [unpack(b) for b in blocks]
    return [np.concatenate(x) for x in zip(*rows)] if rows else []


def by_bucket(bucket: np.ndarray, *arrays: np.ndarray):
    """(bucket, arrays of its rows) for each bucket that has rows."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
    for i, j in zip(cut, np.r_[cut[1:], len(b)]):
        yield int(b[i]), [a[order[i:j]] for a in arrays]


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Even buckets 0..n-1 from the upper half of a hash."""
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def document_blocks(n: int, ids: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """(bucket, block) rows that deal facts about documents to buckets by id."""
    out = [(b, pack(*x)) for b, x in by_bucket(bucket_of(mix(ids.astype(np.uint64)), n), ids, *columns)]
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()),
                                       pa.array([x for _, x in out], pa.binary())], names=["bucket", "block"])


def by_document(blocks: DataFrame, n: int, name: str) -> DataFrame:
    """(id, name): the facts of ``document_blocks`` rows, one flat list per document."""
    def lists(batches):
        packed = [b.column(1)[k].as_py() for b in batches for k in range(b.num_rows)]
        if not packed:
            return
        ids, *columns = join_blocks(packed)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        cut = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
        flat = np.stack([c[order].astype(np.int64) for c in columns], axis=1).reshape(-1)
        offsets = np.append(cut, len(ids)).astype(np.int32) * len(columns)
        yield pa.RecordBatch.from_arrays([pa.array(ids[cut]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                         names=["id", name])

    return blocks.repartitionById(n, "bucket").mapInArrow(lists, f"id long, {name} array<long>")
