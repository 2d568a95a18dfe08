"""Operator 8: MinHash near-duplicates by an LSH forest.

A document is the set of its distinct ``shingle``-word shingles (lower-case
A-Z; shorter texts are one shingle).  Two documents are linked if 100 times
the intersection is at least ``percent`` times the union; links are confirmed
on full sets, and components are the smallest id reachable.

* Equal sets are one class; only its smallest id goes on.
* Each class gets a signature of 128 minimum hashes.  The forest has 32 sorted
  orders; order t reads the signature from position 4t on.  Documents that
  agree on the first four values of an order form a region there (a pair at
  the threshold misses all 32 regions with a chance of 5e-8).
* In a region documents are sorted by the values that follow, so the
  neighbours are those with the longest common prefix: the depth adapts to
  how dense the region is.  Candidates are the neighbours on that order and
  the region's smallest document.  The candidates are linear in the region's size.
* Inside a map task a region of more than HOT documents is worked on at once
  and only HOT of them travel, so a group that holds a third of all rows costs
  a reducer HOT rows per map task.
* Each document's best candidates (most regions in common) are confirmed on
  the full 64-bit shingle sets and joined to components; then every other
  candidate pair that still lies between two components is confirmed too, so
  no candidate is left out.
* The regions are then completed: in every region of more than FULL documents
  that still holds two components, each pair between components is compared.
  The documents outside the region's largest component look, all documents are
  seen; both sides are cut into chunks of CHUNK documents, and each pair of chunks
  meets in a place of its own, so no place grows with the region.  The parities of the shingles on 1024 bits
  bound the difference of two sets from below, so a pair they rule out is no
  link; the others are confirmed on the full sets like the first candidates.

So every pair that shares a region is either in one component or compared in
full; only a pair that shares none of the 32 regions is missed.

Defined results: null, empty and blank texts have an empty set and no link;
a row with a null id has a null component, is kept and links nothing; rows that
share an id count as one node (in the filter form, those that share id and text);
other columns are left out of the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.arrays import BASE, LOWER_CODE, U64, column_bytes, group_edges, mix, slices, word_hashes
from kpiloom.llm.components import joined
from kpiloom.llm.tables import (LAST, batch_rows, bucket_of, by_bucket, join_blocks, free_names, key_columns, keyed, original_id, pack,
                                partitions, stored)

ORDERS, DEPTH = 32, 4
VALUES = ORDERS * DEPTH
WIDTHS = ((9, 8), (32, 4), (None, 1))  # (documents of a region, neighbours proposed on the order): small ones in full
FULL = WIDTHS[0][0]        # documents of a region whose pairs are all proposed at once
CHUNK = 1024               # documents of a large region that are compared in one place
PARITY = 16                # words of 64 bits that hold the parities of a set
REPEATED = 100_000         # rows dealt together where the regions are completed
BUCKET_ROWS = 200_000      # rows of the places that a task compares at once
CELLS = 1 << 20            # words of parities compared at once
PAIRS = 200                # pairs of sets in a batch
BEST = 2                   # candidates of each document confirmed before the rest
HOT = 64                   # documents of a region that a map task sends on
FLUSH = 10_000             # documents dealt together inside a map task


def shingle_sets(words: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every document, one after another, and where each ends."""
    n, size = len(before) - 1, np.diff(before)
    if not len(words):
        return np.zeros(0, U64), np.zeros(n, np.int64)
    h = words.copy()
    for j in range(1, min(k, len(h))):
        h[:len(h) - j] = mix(h[:len(h) - j] * U64(BASE) ^ words[j:])
    parts = []
    for i in range(n):
        a, b = before[i], before[i + 1]
        if size[i] >= k:
            parts.append(np.unique(h[a:b - k + 1]))
        elif size[i]:
            one = U64(0)
            for w in words[a:b]:
                one = mix(np.array([one], U64) * U64(BASE) ^ w)[0]
            parts.append(mix(np.array([one], U64) ^ U64(size[i])))
        else:
            parts.append(words[:0])
    return np.concatenate(parts), np.cumsum([len(p) for p in parts])


def sketch_columns(sets: np.ndarray, ends: np.ndarray):
    """Per document: size, two set fingerprints, 32 region keys, 32 x 4 following signature bytes, 1024 parities."""
    n = len(ends)
    size = np.diff(ends, prepend=0)
    full = np.flatnonzero(size)
    begin = (ends - size)[full]
    prints = np.zeros((2, n), U64)
    sig = np.zeros((VALUES, n), np.uint32)
    parity = np.zeros((PARITY, n), U64)
    if len(full):
        at = mix(sets ^ U64(0x2545F4914F6CDD1D))
        word, bit = at >> U64(6) & U64(PARITY - 1), U64(1) << (at & U64(63))
        for w in range(PARITY):
            parity[w, full] = np.bitwise_xor.reduceat(np.where(word == U64(w), bit, U64(0)), begin)
        for row, salt in zip(prints, (U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F))):
            row[full] = np.add.reduceat(mix(sets ^ salt), begin)
        for f, a in enumerate(mix(np.arange(1, VALUES + 1, dtype=U64) * U64(BASE))):
            sig[f, full] = np.minimum.reduceat((sets * (a | U64(1))) >> U64(32), begin)
    keys = np.zeros((n, ORDERS), U64)
    for t in range(ORDERS):
        h = np.full(n, t + 1, U64)
        for f in range(DEPTH * t, DEPTH * (t + 1)):
            h = mix(h * U64(BASE) ^ sig[f])
        keys[:, t] = h
    after = np.roll(sig.astype(np.uint8), -DEPTH, axis=0).reshape(ORDERS, DEPTH, n)
    deep = np.zeros((n, ORDERS), np.uint32)
    for d in range(DEPTH):
        deep = deep << np.uint32(8) | after[:, d].T.astype(np.uint32)
    return size, prints[0].view(np.int64), prints[1].view(np.int64), keys, deep, parity.T


def neighbours(key: np.ndarray, deep: np.ndarray, ids: np.ndarray, size: np.ndarray,
               percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (x, y) of each region (equal ``key``), if the sizes allow the similarity: the
    neighbours before x on the sorted order, as many as WIDTHS gives the region, and its smallest id."""
    order = np.lexsort((ids, deep, key))
    k, i, s = key[order], ids[order], size[order]
    edges = group_edges(k)
    count = np.diff(np.append(edges, len(k)))
    region = np.repeat(np.arange(len(edges)), count)
    width = np.select([count <= most for most, _ in WIDTHS[:-1]], [w for _, w in WIDTHS[:-1]], WIDTHS[-1][1])[region]
    widest = max(w for _, w in WIDTHS)
    x, y = [], []

    def offer(a, b):
        ok = (i[a] != i[b]) & (100 * np.minimum(s[a], s[b]) >= percent * np.maximum(s[a], s[b]))
        x.append(i[a[ok]])
        y.append(i[b[ok]])

    every = np.arange(len(k))
    for d in range(1, min(widest, len(k) - 1) + 1):
        a = every[d:][(region[d:] == region[:-d]) & (width[d:] >= d)]
        offer(a, a - d)
    if len(k):
        by_id = np.lexsort((i, region))
        offer(every, by_id[group_edges(region[by_id])][region])
    return (np.concatenate(x), np.concatenate(y)) if x else (i, i)


def mixed_regions(key: np.ndarray) -> np.ndarray:
    """Rows of the regions that hold two documents or more."""
    order = np.argsort(key, kind="stable")
    edges = group_edges(key[order])
    count = np.diff(np.append(edges, len(order)))
    return order[np.repeat(count > 1, count)]


def propose(base: DataFrame, percent: int) -> DataFrame:
    """(x, y, hits): candidate pairs over all orders, x > y, with the regions they meet in.

    ``base`` has (id, n, keys, deep).
    """
    n = partitions(base.sparkSession)

    def pairs(x, y):
        low, high = np.minimum(x, y), np.maximum(x, y)
        order = np.lexsort((low, high))
        low, high = low[order], high[order]
        edges = group_edges(high, low)
        return high[edges], low[edges], np.diff(np.append(edges, len(low)))

    def rows(batch):
        keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), U64).reshape(-1, ORDERS)
        deep = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint32).reshape(-1, ORDERS)
        return [np.repeat(x, ORDERS) for x in (batch.column(0).to_numpy(), batch.column(1).to_numpy())] \
            + [keys.reshape(-1), deep.reshape(-1)]

    def deal(batches):
        held, have = [], 0
        for batch in batches:
            held.append(rows(batch))
            have += batch.num_rows
            if have >= FLUSH:
                yield flush(held)
                held, have = [], 0
        if held:
            yield flush(held)

    def flush(held):
        ids, size, key, deep = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(key, kind="stable")
        edges = group_edges(key[order])
        count = np.diff(np.append(edges, len(order)))
        rank = np.arange(len(order)) - np.repeat(edges, count)
        hot = np.repeat(count > HOT, count)
        inside = order[hot]
        x, y = neighbours(key[inside], deep[inside], ids[inside], size[inside], percent)
        x, y, hits = pairs(x, y)
        on = order[~hot | (rank < HOT)]
        on.sort()                                  # by document: neighbours compress
        sent = dict(by_bucket(bucket_of(key[on], n), key[on].astype(np.uint32), deep[on], ids[on],
                              size[on].astype(np.int32)))
        done = dict(by_bucket(bucket_of(mix(x.astype(U64)), n), x, y, hits))
        none = [np.zeros(0, t) for t in (np.uint32, np.uint32, np.int64, np.int32)]
        out = [(b, pack(*sent.get(b, none), *done.get(b, [x[:0], y[:0], hits[:0]]))) for b in sorted({*sent, *done})]
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()),
                                           pa.array([p for _, p in out], pa.binary())], names=["bucket", "block"])

    def meet(batches):
        blocks = [b.column(1)[r].as_py() for b in batches for r in range(b.num_rows)]
        if not blocks:
            return
        key, deep, ids, size, x, y, hits = join_blocks(blocks)
        some = mixed_regions(key)
        a, b, c = pairs(*neighbours(key[some], deep[some], ids[some], size[some].astype(np.int64), percent))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in ((x, a), (y, b), (hits, c))],
                                         names=["x", "y", "hits"])

    dealt = base.select("id", "n", "keys", "deep").mapInArrow(deal, "bucket int, block binary").repartitionById(n, "bucket")
    return dealt.mapInArrow(meet, "x long, y long, hits long").groupBy("x", "y").agg(F.sum("hits").alias("hits"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b), stored: the pairs whose full sets are similar enough."""
    one = pairs.join(sets.select(F.col("id").alias("x"), F.col("shingles").alias("left")).hint("merge"), "x")
    both = one.join(sets.select(F.col("id").alias("y"), F.col("shingles").alias("right")).hint("merge"), "y") \
        .select("x", "y", "left", "right")

    def check(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for r in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[r].as_buffer(), U64) for c in (2, 3))
                small, large = (a, b) if len(a) < len(b) else (b, a)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                ok[r] = 100 * both >= percent * (len(a) + len(b) - both)
            some = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(some), batch.column(1).filter(some)], names=["a", "b"])

    with batch_rows(pairs.sparkSession, PAIRS):      # two whole sets a row
        return stored(both.mapInArrow(check, "a long, b long"))


def tiles(key: np.ndarray, total: np.ndarray, others: np.ndarray, main: np.ndarray, ids: np.ndarray, group: np.ndarray):
    """Batches of (row, place, role): the places where the documents of a region meet.

    ``total`` documents of a region are seen, ``others`` of them, those outside its component ``main``, look.
    A document looks in its chunk of the lookers with every chunk of the seen, and is seen the other way round.
    Roles: 0 is seen, of the main component; 1 looks; 2 looks and is seen; 3 is seen.
    """
    looks, seen = -(-others // CHUNK), -(-total // CHUNK)
    h = mix(ids.astype(U64))
    own = (h % seen.astype(U64)).astype(np.int64)
    turn = (mix(h) % looks.astype(U64)).astype(np.int64)
    outer = group != main
    times = np.where(outer, looks + seen - 1, looks)
    before = np.cumsum(times)
    i = 0
    while i < len(key):
        j = max(i + 1, int(np.searchsorted(before, before[i] - times[i] + REPEATED, side="right")))
        row = np.repeat(np.arange(i, j), times[i:j])
        nth = np.arange(len(row)) - np.repeat(before[i:j] - times[i:j] - (before[i] - times[i]), times[i:j])
        # an outer document first looks at each chunk, then is seen by the chunks of lookers but its own
        looking = outer[row] & (nth < seen[row])
        by = np.where(outer[row], nth - seen[row], nth)
        by = np.where(outer[row] & (by >= turn[row]), by + 1, by)
        by = np.where(looking, turn[row], by)
        at = np.where(looking, nth, own[row])
        role = np.where(~outer[row], 0, np.where(~looking, 3, np.where(at == own[row], 2, 1))).astype(np.int8)
        yield row, mix(mix(key[row].astype(U64) * U64(BASE) ^ by.astype(U64)) * U64(BASE) ^ at.astype(U64)), role
        i = j


def complete(now: DataFrame, percent: int) -> DataFrame:
    """(x, y, hits): every pair of two components in a region of more than FULL documents that the
    parities do not rule out, x > y; of higher ``hits``, the closer their parities are.

    ``now`` has (id, n, keys, parity, component).
    """
    n = partitions(now.sparkSession)

    def keys_of(batches):
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), *(pa.array(np.repeat(batch.column(c).to_numpy(), ORDERS)) for c in (0, 1))],
                names=["key", "id", "component"])

    member = now.select("id", "component", "keys").mapInArrow(keys_of, "key long, id long, component long")
    shares = member.groupBy("key", "component").agg(F.count("*").alias("share"))
    mixed = stored(shares.groupBy("key").agg(F.sum("share").alias("total"), F.count("*").alias("components"),
                                             F.max(F.struct("share", "component")).alias("main"))
                   .where((F.col("total") > FULL) & (F.col("components") > 1))
                   .select("key", "total", (F.col("total") - F.col("main.share")).alias("others"),
                           F.col("main.component").alias("main")))
    looks, seen = (F.ceil(F.col(c) / CHUNK) for c in ("others", "total"))
    dealt_rows = mixed.agg(F.sum(F.col("total") * looks + F.col("others") * (seen - 1)).alias("rows")).first()["rows"] or 0
    buckets = max(n, -(-int(dealt_rows) // BUCKET_ROWS))
    met = member.select("key", "id").join(mixed, "key").join(now.select("id", "n", "component", "parity"), "id") \
        .select("key", "total", "others", "main", "id", "n", "component", "parity")

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key, total, others, main, ids, size, group = (batch.column(c).to_numpy() for c in range(7))
            parity = np.frombuffer(b"".join(batch.column(7).to_pylist()), U64).reshape(-1, PARITY)
            for row, place, role in tiles(key, total, others, main, ids, group):
                out = [(b, pack(*x)) for b, x in by_bucket(bucket_of(place, buckets), place, role, ids[row], size[row],
                                                           group[row], parity[row])]
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()),
                                                  pa.array([x for _, x in out], pa.binary())], names=["bucket", "block"])

    def met_in(blocks):
        place, role, ids, size, group, parity = join_blocks(blocks)
        parity = parity.reshape(-1, PARITY)
        order = np.lexsort((ids, place))
        edges = group_edges(place[order])
        x, y, hits = [], [], []
        for a, b in zip(edges, np.append(edges[1:], len(order))):
            rows = order[a:b]
            look, seen = rows[(role[rows] == 1) | (role[rows] == 2)], rows[role[rows] != 1]
            step = max(1, CELLS // (PARITY * max(1, len(seen))))
            for k in range(0, len(look) if len(seen) else 0, step):
                p, q = look[k:k + step, None], seen[None]
                ok = (group[p] != group[q]) & ((role[q] == 0) | (ids[q] < ids[p])) \
                    & (100 * np.minimum(size[p], size[q]) >= percent * np.maximum(size[p], size[q]))
                r, c = np.nonzero(ok)
                p, q = look[k + r], seen[c]
                apart = np.bitwise_count(parity[p] ^ parity[q]).sum(axis=1, dtype=np.int64)
                both = size[p] + size[q]
                ok = (100 + percent) * apart <= (100 - percent) * both
                p, q = p[ok], q[ok]
                x.append(np.maximum(ids[p], ids[q]))
                y.append(np.minimum(ids[p], ids[q]))
                hits.append(-(1000 * apart[ok] // both[ok]))
        if x:
            x, y, hits = (np.concatenate(v) for v in (x, y, hits))
            order = np.lexsort((y, x))
            order = order[group_edges(x[order], y[order])]
            yield pa.RecordBatch.from_arrays([pa.array(v[order]) for v in (x, y, hits)], names=["x", "y", "hits"])

    def compare(batches):
        held, now_in = [], None
        for batch in batches:                        # the blocks of a bucket follow one another
            for r, bucket in enumerate(batch.column(0).to_pylist()):
                if held and bucket != now_in:
                    yield from met_in(held)
                    held = []
                held.append(batch.column(1)[r].as_py())
                now_in = bucket
        if held:
            yield from met_in(held)

    dealt = met.mapInArrow(deal, "bucket int, block binary").repartitionById(n, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(compare, "x long, y long, hits long").groupBy("x", "y").agg(F.max("hits").alias("hits"))


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row."""
    out = row_components(keyed(df, id_col, text_col), shingle, percent)
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return out.select(original_id(df, id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                      kept.alias("kept"))


def without_near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                            percent: int = 80) -> DataFrame:
    """One row of each component, all columns unchanged: the smallest id.  Different texts that share
    an id are nodes of their own; rows with the same id and text are one."""
    key = key_columns(df, id_col, text_col)
    named = key["id"] < LAST
    # a node for each id and text; the id goes along in the place of the variant
    node = F.when(named, F.xxhash64(key["id"], key["variant"]).bitwiseAND(F.lit(LAST >> 1))).otherwise(F.lit(LAST))
    other = F.when(named, key["id"]).otherwise(key["variant"])
    docs = df.select(node.alias("id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"), other.alias("variant"))
    rows = row_components(docs, shingle, percent)
    stay = rows.groupBy(F.coalesce("component", "variant").alias("group"), F.col("component").isNull().alias("unnamed")) \
        .agg(F.min(F.struct("variant", "id")).alias("first")).select("first.id", "first.variant")
    one, two = free_names(df, "node", "other")
    marked = df.withColumns({one: node, two: other})
    return marked.join(stay, (marked[one] == stay["id"]) & (marked[two] == stay["variant"]), "left_semi") \
        .dropDuplicates([one, two]).drop(one, two)


def row_components(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, variant, n, component) of every row of ``keyed`` documents; null component for a null id."""

    def sketch(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                words, before, _, _ = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], LOWER_CODE)
                size, one, two, keys, deep, parity = sketch_columns(*shingle_sets(words, before, shingle))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(size), pa.array(one), pa.array(two),
                     pa.array([x.tobytes() for x in keys], pa.binary()),
                     pa.array([x.tobytes() for x in deep], pa.binary()),
                     pa.array([x.tobytes() for x in parity], pa.binary())],
                    names=["id", "variant", "n", "one", "two", "keys", "deep", "parity"])

    base = stored(docs.select("id", "text", "variant").mapInArrow(
        sketch, "id long, variant long, n long, one long, two long, keys binary, deep binary, parity binary"))
    real = base.where((F.col("n") > 0) & (F.col("id") < LAST))
    classes = stored(real.groupBy("one", "two", "n").agg(F.min(F.struct("id", "keys", "deep", "parity")).alias("least")))
    stand = classes.select("least.id", "n", "least.keys", "least.deep", "least.parity")

    def hashed(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                words, before, _, _ = word_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], LOWER_CODE)
                sets, ends = shingle_sets(words, before, shingle)
                at = np.concatenate([[0], ends])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i),
                     pa.array([sets[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())],
                    names=["id", "shingles"])

    def sets_of(pairs: DataFrame) -> DataFrame:
        """The shingle sets of the documents of some pairs, by the same join at any size."""
        needed = pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct()
        return stored(docs.select("id", "text").join(needed.hint("merge"), "id").mapInArrow(hashed, "id long, shingles binary")
                      .where(F.length("shingles") > 0))

    def outside(pairs: DataFrame, found: DataFrame) -> DataFrame:
        """The pairs that lie between two components."""
        side = {c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in ("x", "y")}
        return pairs.join(side["x"], "x", "left").join(side["y"], "y", "left") \
            .where(F.coalesce("x_in", "x") != F.coalesce("y_in", "y")).select(*pairs.columns)

    def settle(candidates: DataFrame, found: DataFrame | None) -> DataFrame:
        """Components ``found`` after the candidates: each document's best first, then those still between components."""
        sets = sets_of(candidates)
        top = F.slice(F.sort_array(F.collect_list(F.struct("hits", F.negative("y").alias("z"))), asc=False), 1, BEST)
        best = stored(candidates.groupBy("x").agg(top.alias("top")).select("x", F.explode("top").alias("t"))
                      .select("x", F.negative("t.z").alias("y")))
        found = joined(found, confirm(best, sets, percent))
        return joined(found, confirm(outside(candidates.select("x", "y"), found).join(best, ["x", "y"], "left_anti"), sets,
                                     percent))

    candidates = stored(propose(stand, percent))
    found = settle(candidates, None)
    now = stand.join(found.select(F.col("node").alias("id"), "component"), "id", "left") \
        .withColumn("component", F.coalesce("component", "id"))
    more = stored(complete(now, percent).join(candidates.select("x", "y"), ["x", "y"], "left_anti"))
    if not more.isEmpty():
        found = settle(more, found)

    least = base.select("id", "variant", "n", "one", "two") \
        .join(classes.select("one", "two", "n", F.col("least.id").alias("least")), ["one", "two", "n"], "left")
    return least.join(found.select(F.col("node").alias("least"), "component"), "least", "left") \
        .select("id", "variant", "n",
                F.when(F.col("id") < LAST, F.coalesce("component", "least", "id")).alias("component"))
