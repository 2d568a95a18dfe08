"""Operator 9 [native]: sharding by a k-d tree over document metadata.

The table is cut recursively: a node that is to become k shards is split at
the weighted (by bytes) quantile that gives its left side ceil(k / 2) / k of
its bytes, along the dimension in which it is widest (its extent relative to
the table's), until every leaf is one shard of about the target bytes.

* Units are groups of equal texts: one weight, the smallest metadata of the
  group, so copies lie in one place and hot groups are added up before any
  shuffle.  A group above a hundredth of a shard is divided into pieces by id,
  which lie side by side; only a cut that falls into such a group parts it.
* A weighted quantile is found by radix descent on one sortable number
  (coordinate, text hash, piece): five sums into 4,096 classes a node, so a
  level needs 4,096 rows a node and its result is exact to a piece.
* The cuts of a level (one row a node, at most as many as shards) are joined
  as an inline table; units are stored after each level.
* Slots number each shard's rows without gaps: rows are numbered inside small
  hash classes and shifted by the classes' running counts.

Only DataFrame functions run.  Defined results: null text has size 1 like the
empty text; null metadata counts as the smallest; repeated rows each get a
slot; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.tables import partitions, released, stored

COORDINATE, HASH, PIECE = 20, 28, 12       # bits of the sortable number
STEP = 12                                  # bits of one descent step
UNIT = ["text_crc32", "size", "mark", "piece"]


def default_dimensions(df: DataFrame, text: Column) -> dict[str, Column]:
    """Numbers a document is placed by: bytes, share of wide characters, and its
    language and source where the table has them."""
    size, chars = F.octet_length(text), F.char_length(text)
    out = {"log_bytes": F.log1p(size.cast("double")), "wide": (size - chars) / F.greatest(size, F.lit(1))}
    for c in ("lang", "source"):
        if c in df.columns:
            out[c] = F.crc32(F.coalesce(df[c].cast("string"), F.lit("")).cast("binary")) / 2.0 ** 32
    return out


def kd_shards(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int | None = 8,
              target_bytes: int | None = None, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row, in ``shards`` shards or shards of ``target_bytes``."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    dims = dimensions or default_dimensions(df, text)
    thin = df.select(df[id_col].alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("mark"),
                     F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in dims.values()]).alias("at"))
    thin = stored(thin)
    total = thin.agg(F.sum("size")).first()[0] or 0
    n = shards or max(1, round(total / max(1, target_bytes or total)))
    step = max(1, total // (100 * n))
    rows, units = pieces(thin, step, len(dims))
    units = stored(units.withColumn("node", F.lit(0)))
    shards_of, leaf = {0: n}, {}
    while shards_of:
        cuts = level_cuts(units, shards_of, len(dims))
        units = stored(apply_cuts(units, cuts))
        released(units.sparkSession)
        shards_of = {child: k for node, k in shards_of.items() if k > 1
                     for child, k in ((2 * node + 1, (k + 1) // 2), (2 * node + 2, k // 2))}
        leaf.update({node: None for node, k in shards_of.items() if k == 1})
        shards_of = {node: k for node, k in shards_of.items() if k > 1}
    order = sorted(leaf or {0: None}, key=path)
    name = units.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(f"({x}, {i})" for i, x in enumerate(order))
                                  + " AS t(node, shard)")
    placed = rows.join(units.join(F.broadcast(name), "node").select(*UNIT, "shard"), UNIT)
    return slots(placed.select("id", "size", "text_crc32", "mark", "shard"), id_col)


def path(node: int) -> list[int]:
    """The turns from the root to a node (0 left, 1 right), which order the leaves."""
    turns = []
    while node:
        turns.append((node - 1) % 2)
        node = (node - 1) // 2
    return turns[::-1]


def pieces(thin: DataFrame, step: int, d: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the piece of their group, and the units: groups, or pieces of the large ones."""
    groups = stored(thin.groupBy("text_crc32", "size", "mark")
                    .agg(F.sum("size").alias("bytes"), *[F.min(F.col("at")[i]).alias(f"d{i}") for i in range(d)]))
    # at most total / step = 100 x shards groups are this large
    large = groups.where(F.col("bytes") > step) \
        .select("text_crc32", "size", "mark", F.least(F.ceil(F.col("bytes") / step), F.lit(1 << PIECE)).alias("parts"))
    rows = thin.drop("at").join(F.broadcast(large), ["text_crc32", "size", "mark"], "left") \
        .withColumn("piece", F.coalesce(F.pmod(F.xxhash64("id"), "parts"), F.lit(0)).cast("int")).drop("parts")
    small = groups.join(F.broadcast(large), ["text_crc32", "size", "mark"], "left_anti").withColumn("piece", F.lit(0))
    parted = rows.join(F.broadcast(large), ["text_crc32", "size", "mark"], "left_semi").groupBy(*UNIT) \
        .agg(F.sum("size").alias("bytes"))
    parted = parted.join(F.broadcast(groups.join(F.broadcast(large), ["text_crc32", "size", "mark"], "left_semi")
                                     .drop("bytes")), ["text_crc32", "size", "mark"])
    return rows, small.unionByName(parted.select(small.columns))


def sort_number(dim: Column, low: Column, high: Column) -> Column:
    """Coordinate, then text hash, then piece, as one number of 60 bits."""
    top = float((1 << COORDINATE) - 1)
    q = F.when(high > low, F.floor((dim - low) / (high - low) * top)).otherwise(F.lit(0)).cast("long")
    h = F.shiftrightunsigned(F.xxhash64("mark", "text_crc32"), 64 - HASH)
    return F.shiftleft(q, HASH + PIECE).bitwiseOR(F.shiftleft(h, PIECE)).bitwiseOR(F.col("piece").cast("long"))


def level_cuts(units: DataFrame, shards_of: dict[int, int], d: int) -> list[tuple]:
    """(node, dimension, low, high, cut) of every node to split: units below the cut go left."""
    spark = units.sparkSession
    extent = [x for i in range(d) for x in (F.min(f"d{i}").alias(f"lo{i}"), F.max(f"d{i}").alias(f"hi{i}"))]
    live = units.where(F.col("node").isin(list(shards_of)))
    stats = live.groupBy("node").agg(F.sum("bytes").alias("bytes"), *extent).collect()
    whole = units.agg(*extent).first()
    state = []
    for r in stats:
        span = [(r[f"hi{i}"] - r[f"lo{i}"]) / ((whole[f"hi{i}"] - whole[f"lo{i}"]) or 1.0) for i in range(d)]
        i = max(range(d), key=lambda j: (span[j], -j))
        k = shards_of[r.node]
        state.append([r.node, i, r[f"lo{i}"], r[f"hi{i}"], r.bytes * ((k + 1) // 2) / k, 0])
    if not state or max(shards_of.values()) < 2:
        return []
    bits = COORDINATE + HASH + PIECE
    for shift in range(bits - STEP, -1, -STEP):
        now = spark.sql("SELECT * FROM VALUES " + ", ".join(
            f"({n}, {i}, double({lo!r}), double({hi!r}), double({want!r}), {prefix}L)" for n, i, lo, hi, want, prefix in state)
            + " AS t(node, dim, low, high, want, prefix)")
        number = sort_number(F.array(*[f"d{i}" for i in range(d)])[F.col("dim")], F.col("low"), F.col("high"))
        near = live.join(F.broadcast(now), "node").withColumn("number", number) \
            .where(F.shiftright("number", shift + STEP) == F.col("prefix"))
        sums = near.groupBy("node", "want", F.shiftright("number", shift).alias("class")).agg(F.sum("bytes").alias("w"))
        up_to = Window.partitionBy("node").orderBy("class")
        run = sums.withColumn("upto", F.sum("w").over(up_to))
        # the class in which the wanted weight lies (the last one, if rounding leaves none)
        here = run.groupBy("node").agg(
            F.min(F.when(F.col("upto") >= F.col("want"), F.struct("class", "upto", "w"))).alias("hit"),
            F.max(F.struct("class", "upto", "w")).alias("last")) \
            .select("node", F.coalesce("hit", "last").alias("x")).select("node", "x.*").collect()
        found = {r.node: r for r in here}
        for s in state:
            r = found[s[0]]
            s[4], s[5] = s[4] - (r.upto - r.w), r["class"]
            if shift == 0 and 2 * s[4] > r.w:
                s[5] += 1                    # the unit itself goes left: nearer to the wanted weight
    return [tuple(s[:4]) + (s[5],) for s in state]


def apply_cuts(units: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Units with the child node they fall into."""
    if not cuts:
        return units
    d = sum(c.startswith("d") and c[1:].isdigit() for c in units.columns)
    table = units.sparkSession.sql("SELECT * FROM VALUES " + ", ".join(
        f"({n}, {i}, double({lo!r}), double({hi!r}), {cut}L)" for n, i, lo, hi, cut in cuts)
        + " AS t(node, dim, low, high, cut)")
    number = sort_number(F.array(*[f"d{i}" for i in range(d)])[F.col("dim")], F.col("low"), F.col("high"))
    child = F.when(F.col("cut").isNull(), F.col("node")) \
        .otherwise(2 * F.col("node") + F.when(number < F.col("cut"), 1).otherwise(2))
    return units.join(F.broadcast(table), "node", "left").withColumn("node", child.cast("int")) \
        .drop("dim", "low", "high", "cut")


def slots(placed: DataFrame, id_col: str) -> DataFrame:
    """Number each shard's rows from 0 without gaps."""
    n = partitions(placed.sparkSession)
    rows = stored(placed.withColumn("class", F.pmod(F.xxhash64("id", "mark"), F.lit(n)).cast("int")))
    counts = rows.groupBy("shard", "class").agg(F.count("*").alias("c"))
    before = counts.withColumn("before", F.sum("c").over(Window.partitionBy("shard").orderBy("class")) - F.col("c"))
    number = F.row_number().over(Window.partitionBy("shard", "class").orderBy("id", "mark"))
    return rows.withColumn("number", number).join(before.drop("c"), ["shard", "class"]) \
        .select(F.col("id").alias(id_col), "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                (F.col("before") + F.col("number") - 1).alias("slot"))
