"""Merkle manifest of a table: a hash tree per group, a tree over the groups, a proof per row.

The leaf of a row is the hash of its columns (``leaf_hash``).  The leaves of a
group stand in order; ``fan`` consecutive nodes become the hash of their
concatenated hex digests, an uneven rest too, until one node is left, the
group's subroot.  The subroots in order of their groups form the last tree.

Every aligned block of ``fan ** k`` nodes keeps a level as one string of hex
digests.  Fixed-width substrings of a level hash to the next one; the
substrings that flank a node inside its run are its sibling segment.  The tops
of the blocks are the nodes of the next round, so a round divides the nodes by
the block size and the recursion is a few rounds deep at any size.  A leaf's
proof is its block's segments, its block's own proof in the next round, and so
on up to the root.

Places in a group come from a range partitioning by (group, order, leaf) and
the counts of the partitions before, so no group is sorted in one task; equal
rows are told apart by a number of their own.  Only DataFrame functions.

Defined results: a null column enters the leaf as ``-``; a null group is a
group of its own and stands first, a null order value stands first in its
group; rows with equal order value stand by their leaves, and repeated rows each
have a place.  An empty text is a value of no bytes; texts of any length are
hashed whole.  A group of one row has its leaf as subroot, a table of one group
its subroot as root.  An empty table gives an empty result.  Columns outside
``columns`` are not read; ``carried`` columns come back under their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.tables import partitions, stored

HEX = 64                # characters of a digest
BLOCK = 256             # nodes of a block, at most
SEGMENT = "struct<before:string,after:string>"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(*values: Column) -> Column:
    """Hex SHA-256 of the values, each ``-`` if null, else UTF-8 byte count, colon, value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_text(proof: Column) -> Column:
    """The siblings of a proof, left to right and level by level, as one string."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def merkle_manifest(rows: DataFrame, columns: Sequence[str] = COLUMNS, order: str = "doc_id", group: str = "lang",
                    fan: int = 2, carried: dict[str, Column] | None = None) -> DataFrame:
    """(order column, carried columns, leaf, proof, subroot, root) of every row.

    ``proof`` is an array of (before, after) sibling segments, leaf to root.
    """
    names = list(carried or {})
    if {"leaf", "proof", "subroot", "root", order} & set(names):
        raise ValueError("a carried column has the name of a result column")
    leaves = stored(rows.select(
        _group_key(rows[group]).alias("grp"), rows[order].alias("ord"),
        leaf_hash(*[rows[c] for c in columns]).alias("node"),
        F.struct(rows[order].alias("ord"), *[(carried or {})[n].alias(n) for n in names]).alias("carry"),
        F.monotonically_increasing_id().alias("salt")))
    nodes, most = _placed(leaves, [F.col("ord").asc_nulls_first(), "node", "salt"])
    out = _climb(nodes, most, fan, lambda tops: _crown(tops, fan))
    return out.select(F.col("carry.ord").alias(order), *[F.col("carry")[n].alias(n) for n in names],
                      F.col("node").alias("leaf"), "proof", F.col("ends.subroot").alias("subroot"),
                      F.col("ends.root").alias("root"))


def _group_key(group: Column) -> Column:
    """A group's name as text that is never null and puts the null group first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def _placed(nodes: DataFrame, order: Sequence) -> tuple[DataFrame, int]:
    """``nodes`` with ``pos`` (0.. in its group) and ``n`` (nodes of the group); the largest n."""
    ranged = nodes.repartitionByRange(partitions(nodes.sparkSession), "grp", *order) \
        .sortWithinPartitions("grp", *order).withColumn("at", F.monotonically_increasing_id())
    kept = stored(ranged).withColumn("part", F.shiftright("at", 33))
    here = kept.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("c"))
    of_group = Window.partitionBy("grp")
    starts = here.select("grp", "part", F.sum("c").over(of_group).alias("n"),
                         (F.sum("c").over(of_group.orderBy("part")) - F.col("c") - F.col("first")).alias("shift"))
    most = starts.agg(F.max("n")).first()[0] or 0
    return kept.join(starts, ["grp", "part"]) \
        .select("grp", "n", (F.col("at") + F.col("shift")).alias("pos"), "node", "carry"), most


def _climb(nodes: DataFrame, most: int, fan: int, crown: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(carry, node, proof, ends) of nodes (grp, n, pos, node, carry).

    ``crown`` takes the top of every group (grp, top) and gives (grp, above,
    ends): the proof that goes on above the group and what is reported with it.
    """
    deep = max(1, int(math.log(BLOCK, fan) + 1e-9))
    wide = fan ** deep
    levels = F.least(F.lit(deep), F.ceil(F.log(F.col("n").cast("double")) / math.log(fan) - F.lit(1e-9)).cast("int"))
    blocks = nodes.groupBy("grp", "n", F.floor(F.col("pos") / wide).alias("block")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "node", "carry"))).alias("members"))
    lowest = F.array_join(F.transform("members", lambda m: m["node"]), "")
    up = F.when(levels > 0, F.sequence(F.lit(1), levels)).otherwise(F.array().cast("array<int>"))
    blocks = stored(blocks.withColumn("levels", F.aggregate(
        up, F.array(lowest), lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1), fan))))))
    tops = blocks.select("grp", "n", "block", F.element_at("levels", -1).alias("top"))
    if most <= wide:
        upper = crown(tops.select("grp", "top")).withColumn("block", F.lit(0).cast("long"))
    else:
        above = tops.select("grp", F.ceil(F.col("n") / wide).alias("n"), F.col("block").alias("pos"),
                            F.col("top").alias("node"), F.struct("grp", "block").alias("carry"))
        upper = _climb(above, -(-most // wide), fan, crown) \
            .select("carry.grp", "carry.block", F.col("proof").alias("above"), "ends")
    both = blocks.join(upper, ["grp", "block"])
    member = F.transform("members", lambda m, i: F.struct(
        m["carry"].alias("carry"), m["node"].alias("node"),
        F.concat(_segments(i, fan), F.col("above")).alias("proof"), F.col("ends").alias("ends")))
    return both.select(F.inline(member))


def _parents(level: Column, fan: int) -> Column:
    """The next level of a level."""
    runs = F.ceil(F.length(level) / (HEX * fan)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1),
                                    lambda r: F.sha2(level.substr(r * (HEX * fan) + 1, F.lit(HEX * fan)), 256)), "")


def _segments(i: Column, fan: int) -> Column:
    """The sibling segments of the block's i-th node, level by level."""
    def segment(level, k):
        at = F.floor(i / F.pow(F.lit(float(fan)), k)).cast("int")
        run = F.floor(at / fan).cast("int") * fan
        return F.struct(level.substr(run * HEX + 1, (at - run) * HEX).alias("before"),
                        level.substr((at + 1) * HEX + 1, (run + fan - 1 - at) * HEX).alias("after"))
    return F.transform(F.slice("levels", F.lit(1), F.size("levels") - 1), segment)


def _crown(tops: DataFrame, fan: int) -> DataFrame:
    """(grp, above, ends) of the groups: the tree over their subroots."""
    nodes, most = _placed(tops.select(F.lit("").alias("grp"), F.col("grp").alias("ord"), F.col("top").alias("node"),
                                      F.struct(F.col("grp").alias("of"), F.col("top").alias("subroot")).alias("carry")),
                          ["ord"])
    whole = _climb(nodes, most, fan, lambda top: top.select("grp", F.array().cast(f"array<{SEGMENT}>").alias("above"),
                                                            F.col("top").alias("ends")))
    return whole.select(F.col("carry.of").alias("grp"), F.col("proof").alias("above"),
                        F.struct(F.col("carry.subroot").alias("subroot"), F.col("ends").alias("root")).alias("ends"))
