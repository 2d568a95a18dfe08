"""Corrections of a stored table, by partition, with an atomic change of version.

A table is a folder with its data in partition folders, a manifest per version
(which folder holds which partition value) and a pointer file per version.  An
update finds the partitions that hold a row to change, writes those partitions
anew beside the old ones, writes a manifest that names them in place of the old
folders, and last puts the pointer in place by a rename.  Until that rename every
reader sees the old table, so a run that dies at any point leaves it as it was;
readers that have started keep their files.  Untouched partitions are neither
read in full nor written: their rows are only searched for the condition.

One writer at a time; a second one that commits the same version number fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import hadoop_path

VERSIONS, MANIFESTS, DATA, FOLDER = "_versions", "_manifests", "data", "v"


def _files(spark: SparkSession, path: str) -> list[str]:
    fs, where = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, where = hadoop_path(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, where = hadoop_path(spark, path)
    out = fs.create(where, False)
    out.write(bytearray(text.encode()))
    out.close()


def version(spark: SparkSession, root: str) -> int:
    """The number of the current version; 0 if there is no table."""
    return max((int(f) for f in _files(spark, f"{root}/{VERSIONS}") if f.isdigit()), default=0)


def _manifest(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(_read(spark, f"{root}/{MANIFESTS}/{_read(spark, f'{root}/{VERSIONS}/{number:012d}')}"))


def _commit(spark: SparkSession, root: str, number: int, manifest: dict) -> None:
    """Make ``manifest`` version ``number``; the rename of the pointer is the moment of change."""
    name = f"{number:012d}-{uuid.uuid4().hex}.json"
    _write(spark, f"{root}/{MANIFESTS}/{name}", json.dumps(manifest))
    draft = f"{root}/{VERSIONS}/.{uuid.uuid4().hex}"
    _write(spark, draft, name)
    fs, target = hadoop_path(spark, f"{root}/{VERSIONS}/{number:012d}")
    if fs.exists(target) or not fs.rename(hadoop_path(spark, draft)[1], target):
        raise RuntimeError(f"{root}: version {number} was written by another run")


def _store(rows: DataFrame, root: str, partition_by: str, sort_by: str | None) -> dict[str, str]:
    """Write rows into a new data folder, by the tasks that have them; (partition folder name -> folder)."""
    spark, new = rows.sparkSession, f"{FOLDER}={uuid.uuid4().hex}"
    out = rows.sortWithinPartitions(partition_by, sort_by) if sort_by else rows
    out.write.partitionBy(partition_by).parquet(f"{root}/{DATA}/{new}")
    return {f: f"{new}/{f}" for f in _files(spark, f"{root}/{DATA}/{new}") if f.startswith(f"{partition_by}=")}


def create_table(rows: DataFrame, root: str, partition_by: str, sort_by: str | None = None, rebalance: bool = True) -> None:
    """Store ``rows`` as version 1 of a new table; ``rebalance=False`` for rows that come from a large join
    (see ``files.write_table``)."""
    spark, root = rows.sparkSession, root.rstrip("/")
    if version(spark, root):
        raise ValueError(f"{root} holds a table")
    folders = _store(rows.hint("rebalance", partition_by) if rebalance else rows, root, partition_by, sort_by)
    _commit(spark, root, 1, {"partition_by": partition_by, "sort_by": sort_by, "schema": rows.schema.json(), "folders": folders})


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The table at a version (the current one); filters on the partition column prune folders."""
    from pyspark.sql.types import StructType
    root = root.rstrip("/")
    number = number or version(spark, root)
    if not number:
        raise ValueError(f"{root} holds no table")
    held = _manifest(spark, root, number)
    schema = StructType.fromJson(json.loads(held["schema"]))
    if not held["folders"]:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{DATA}/{f}" for f in held["folders"].values()]
    rows = spark.read.schema(schema).option("basePath", f"{root}/{DATA}").parquet(*paths)
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def update_table(spark: SparkSession, root: str, changes: dict[str, Column], where: Column) -> int:
    """SQL ``UPDATE``: set the columns where the condition is true; the number of partitions written.

    NULL conditions change nothing.  The partition column itself cannot change.
    """
    root = root.rstrip("/")
    number = version(spark, root)
    table, held = read_version(spark, root, number or None), None
    held = _manifest(spark, root, number)
    key = held["partition_by"]
    if key in changes:
        raise ValueError(f"{key} is the partition column")
    # one row per partition value, as many as the manifest names
    touched = [r[0] for r in table.where(where).select(key).distinct().collect()]
    if not touched:
        return 0
    mine = F.col(key).isin([t for t in touched if t is not None])
    mine = mine | F.col(key).isNull() if None in touched else mine
    hit = F.coalesce(where, F.lit(False))
    rows = table.where(mine).select(*[
        F.when(hit, changes[f.name].cast(f.dataType)).otherwise(F.col(f"`{f.name}`")).alias(f.name) if f.name in changes
        else F.col(f"`{f.name}`") for f in table.schema.fields])
    # no shuffle: a scan task holds whole files (or splits) of few partitions and writes a file for each
    new = _store(rows, root, key, held["sort_by"])
    _commit(spark, root, number + 1, {**held, "folders": {**held["folders"], **new}})
    return len(new)


def forget_versions(spark: SparkSession, root: str) -> int:
    """Delete the data of all but the current version, also of runs that died; the number of folders deleted."""
    root = root.rstrip("/")
    kept, gone = set(_manifest(spark, root, version(spark, root))["folders"].values()), 0
    for folder in _files(spark, f"{root}/{DATA}"):
        for part in _files(spark, f"{root}/{DATA}/{folder}"):
            if "=" in part and f"{folder}/{part}" not in kept:
                fs, where = hadoop_path(spark, f"{root}/{DATA}/{folder}/{part}")
                fs.delete(where, True)
                gone += 1
    return gone
