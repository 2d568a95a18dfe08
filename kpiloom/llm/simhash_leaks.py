"""Operator 4 [native]: benchmark decontamination by SimHash over item-sized windows.

Documents are compared with every benchmark item over windows of the item's
length.  The similarity is the weighted Jaccard of their ``shingle``-word
shingles (weight: how often a shingle occurs; items shorter than a shingle are
one shingle), reported from ``least`` (0.8) on.

1. Only windows that hold enough of one item can reach the threshold: a window
   of c shingles must share ``least`` / (1 + ``least``) of c and the item's
   weight together.  The documents' shingles are looked up among the items' (a
   hash join; the item side is broadcast only below BROADCAST_ROWS counted
   shingles), and every window that holds so many hit positions is laid,
   in whatever order the item's parts stand there.
2. Each window and item gets a 64-bit SimHash of its shingles.  Multi-index
   lookup: eight blocks of eight bits; if two fingerprints differ in at most
   RADIUS = 23 bits, some block differs in at most two, so the items are filed
   under every block value within two bits and all pairs within the radius
   are found.  Other pairs are dropped by their exact Hamming distance.
3. The pairs found are verified by their exact weighted similarity.

SimHash itself is a random projection: a pair at the threshold differs in 10
bits on average and by more than 23 with a chance of about 1e-5, and an item
is met by several windows.

Only DataFrame functions run.  Defined results: null, empty and blank texts
match nothing, on both sides; a document shorter than an item is one window;
null ids are carried; repeated rows give one row for each pair of ids; extra
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.tables import key_columns, keyed, original_id, partitions, stored

SHINGLE, LEAST = 5, 0.8
BLOCKS, BLOCK_BITS, NEAR = 8, 8, 2
RADIUS = BLOCKS * (NEAR + 1) - 1
BROADCAST_ROWS = 2_000_000     # item shingles (24 bytes each) up to which the item side is broadcast
# counters side by side in one number: (where they stand, the bit above each, the first bits they count)
NARROW = (1 | 1 << 22 | 1 << 44, 18, range(22))
WIDE = (1 | 1 << 31, 30, (*range(31), 62, 63))     # a text of 2 GB has fewer than 2**30 words


def word_codes(text: Column) -> Column:
    """64-bit hashes of the lower-cased words."""
    words = F.filter(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_codes(words: Column, k: int) -> Column:
    """Hashes of the k words from each position on; empty if there are fewer."""
    at = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k))
    return F.coalesce(F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])),
                      F.array().cast("array<long>"))


def majority(codes: Column, counters: tuple) -> Column:
    """64-bit number of the bits that more than half of the hashes have, by the given counters."""
    lanes, top, shifts = counters
    half = F.shiftright(F.size(codes), 1).cast("long")
    # a counter above half reaches its top bit once 2**top - 1 - half is added
    lift = (F.lit((1 << top) - 1).cast("long") - half) * F.lit(lanes)
    out = F.lit(0).cast("long")
    for j in shifts:
        sums = F.aggregate(codes, F.lit(0).cast("long"),
                           lambda a, x: a + F.shiftrightunsigned(x, j).bitwiseAND(F.lit(lanes)))  # noqa: B023
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned((sums + lift).bitwiseAND(F.lit(lanes << top)), top), j))
    return out


def simhash(codes: Column) -> Column:
    """64-bit SimHash of an array of hashes: bit b is set if most of them have it."""
    return F.when(F.size(codes) < 1 << NARROW[1], majority(codes, NARROW)).otherwise(majority(codes, WIDE))


def block(code: Column, b: int) -> Column:
    return F.shiftrightunsigned(code, BLOCK_BITS * b).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def near_values() -> list[int]:
    """Patterns of at most NEAR set bits in a block."""
    return [x for x in range(1 << BLOCK_BITS) if x.bit_count() <= NEAR]


def shared_weight(a: Column, b: Column) -> Column:
    """Sum of min(times in a, times in b) over the values of a."""
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda s, x: s + F.least(
        F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))))


def items_table(items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(item, n, k, codes, print) of every item with words."""
    words = items.select(items[id_col].alias("item"), word_codes(F.coalesce(items[text_col].cast("string"), F.lit("")))
                         .alias("w")).where(F.size("w") > 0).withColumn("n", F.size("w"))
    codes = F.coalesce(*[F.when(F.least("n", F.lit(k)) == j, shingle_codes(F.col("w"), j)) for j in range(1, k + 1)])
    return words.select("item", "n", F.least("n", F.lit(k)).alias("k"), codes.alias("codes")) \
        .withColumn("print", simhash(F.col("codes")))


def leaks(df: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, least: float = LEAST) -> DataFrame:
    """(id, item id, start, n_words, hamming, similarity): the best window of every leaking pair."""
    found = leaking_windows(keyed(df, id_col, text_col), items, item_id, item_text, shingle, least)
    best = found.groupBy("id", "item").agg(F.max(F.struct(
        "similarity", F.negative("start").alias("before"), F.size("codes").alias("m"), "k", "hamming")).alias("x"))
    return best.select(original_id(df, id_col), F.col("item").alias(item_id),
                       F.negative("x.before").cast("int").alias("start"), (F.col("x.m") + F.col("x.k") - 1).alias("n_words"),
                       F.col("x.hamming").alias("hamming"), F.col("x.similarity").alias("similarity"))


def without_leaks(df: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
                  least: float = LEAST) -> DataFrame:
    """The rows of ``df`` that hold no benchmark item, all columns unchanged."""
    bad = leaking_windows(keyed(df, id_col, text_col), items, item_id, item_text, shingle, least) \
        .select("id", "variant").distinct()
    key = key_columns(df, id_col, text_col)
    return df.join(bad, (key["id"] == bad["id"]) & (key["variant"] == bad["variant"]), "left_anti")


def leaking_windows(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, shingle: int,
                    least: float) -> DataFrame:
    """(id, variant, item, start, k, codes, hamming, similarity) of the windows that reach the threshold."""
    bench = stored(items_table(items, item_id, item_text, shingle))
    sizes = [r.k for r in bench.select("k").distinct().collect()]          # at most ``shingle`` numbers
    places = stored(bench.select("item", "n", "k", F.size("codes").alias("weight"),
                                 F.posexplode("codes").alias("place", "code")))
    small = places.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else (lambda x: x)

    key = ["id", "variant"]

    def coded(rows: DataFrame) -> DataFrame:
        """Rows with ``codes``: a struct (k, shingle hashes) for each shingle length in use."""
        w = rows.withColumn("w", word_codes(F.col("text")))
        each = [F.struct(F.lit(k).alias("k"), shingle_codes(F.col("w"), k).alias("codes")) for k in sizes or [shingle]]
        return w.select(*[c for c in rows.columns if c != "text"], F.size("w").alias("words"), F.explode(F.array(*each)).alias("s")) \
            .select("*", "s.k", "s.codes").drop("s")

    seen = coded(docs.select("id", "variant", "text")) \
        .select(*key, "words", "k", F.posexplode("codes").alias("pos", "code"))
    hits = seen.join(hint(places), ["code", "k"]).select(*key, "words", "item", "n", "k", "weight", "pos", "place", "code")
    # the weight a window must share with the item, and the windows that hold so many hits
    weight = F.least("weight", F.col("words") - F.col("k") + 1)
    need = F.ceil((weight + F.col("weight")) * (least / (1 + least)) - 1e-6).cast("int")
    enough = hits.groupBy(*key, "words", "item", "n", "k", "weight") \
        .agg(F.sort_array(F.collect_set("pos")).alias("at")) \
        .withColumn("need", F.greatest(need, F.lit(1))).where(F.size("at") >= F.col("need"))
    last = F.greatest(F.col("words") - F.col("n"), F.lit(0))
    # hit i is the first of a window from the one that just ends with the need-th hit to the one that starts at hit i
    first = lambda i: F.greatest(F.get("at", i + F.col("need") - 1) - F.col("weight") + 1,
                                 F.coalesce(F.get("at", i - 1) + 1, F.lit(0)), F.lit(0))
    spans = F.transform(F.sequence(F.lit(0), F.size("at") - F.col("need")),
                        lambda i: F.struct(first(i).alias("a"), F.least(F.get("at", i), last).alias("b")))
    lay = F.flatten(F.transform(F.filter(spans, lambda x: x["a"] <= x["b"]), lambda x: F.sequence(x["a"], x["b"])))
    laid = stored(enough.select(*key, "k", "n", F.explode(lay).alias("start")).distinct()
                  .groupBy(*key, "k").agg(F.collect_list(F.struct("start", "n")).alias("windows")))

    texts = docs.select("id", "variant", "text").join(laid.select(*key).distinct(), key, "left_semi")
    windows = coded(texts).join(laid, [*key, "k"]) \
        .select(*key, "k", "codes", F.explode("windows").alias("w")).select(*key, "k", "w.start", "w.n", F.expr(
            "slice(codes, w.start + 1, w.n - k + 1)").alias("codes"))
    # small rows but much work on each: dealt evenly, whatever their bytes
    windows = windows.where(F.size("codes") > 0).repartition(partitions(docs.sparkSession), *key, "start", "n") \
        .withColumn("print", simhash(F.col("codes")))

    filed = bench.select("item", "n", "k", "print", "codes",
                         F.explode(F.array(*[F.struct(F.lit(b).alias("b"), block(F.col("print"), b).alias("value"))
                                             for b in range(BLOCKS)])).alias("f")) \
        .select("item", "n", "k", F.col("print").alias("item_print"), F.col("codes").alias("item_codes"), "f.b",
                F.explode(F.transform(F.array(*map(F.lit, near_values())),
                                      lambda x: x.bitwiseXOR(F.col("f.value")))).alias("value"))
    asked = windows.withColumn("f", F.explode(F.array(*[F.struct(F.lit(b).alias("b"), block(F.col("print"), b).alias("value"))
                                                        for b in range(BLOCKS)]))) \
        .select(*key, "k", "start", "n", "codes", "print", "f.b", "f.value")
    # eight blocks may find a pair: it counts at the first of them
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    first = F.coalesce(*[F.when(F.bit_count(block(F.col("print").bitwiseXOR(F.col("item_print")), b).cast("long")) <= NEAR,
                                F.lit(b)) for b in range(BLOCKS)])
    pairs = asked.join(F.broadcast(filed) if bench.count() * BLOCKS * len(near_values()) <= BROADCAST_ROWS else filed,
                       ["k", "n", "b", "value"]) \
        .where((first == F.col("b")) & (distance <= RADIUS))
    both = shared_weight(F.col("codes"), F.col("item_codes"))
    return pairs.withColumn("both", both).withColumn("hamming", distance).withColumn(
        "similarity", F.col("both") / (F.size("codes") + F.size("item_codes") - F.col("both"))) \
        .where(F.col("similarity") >= least)
