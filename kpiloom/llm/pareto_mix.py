"""Operator 3: mixing sources to target weights by Pareto order sampling.

Sources share the table's words by weight; no source takes more than
``most`` times its own words, and the excess is shared anew by weight.  A
document of a source with target / size = e is taken floor(e) times for
certain; what is left of the target goes to a Pareto sample of unequal
probabilities: a document of s words has the inclusion probability
p = min(1, rate * s ** power), where the source's rate makes the sum of p * s
the words that are left.  Documents with p = 1 are certain; the others are
ranked by u / (1 - u) over p / (1 - p) for a uniform u each, and the first ones
are taken until the words are reached (to the nearest document).  ``power`` 0
gives every document the same chance; 0.5 stands between an equal chance for
each document and one for each word.

The rate is exact: sum(s * min(1, rate * s ** power)) is the least of the lines
"all longer documents whole, the rest in proportion", so the rate is the
largest of the lines' solutions, taken over the distinct sizes of the source
(k distinct sizes need k * k / 2 words, so they stay few).

The cut of a source is found without sorting it: two descents sum the words
of 4,096 rank classes a source, and only the rows of the last class (one in
16.7 million) are ordered.  u is a hash of the seed, id and text, so reruns agree.

Defined results: null text has size 0; a document of size 0 is taken only for
certain (its probability is 0 unless ``power`` is 0); a null source is a source
of its own, last; a null id draws by its text; rows repeated with id and text are numbered and
draw one by one; texts are counted whole; a source without words has target 0; other columns are left out
of ``pareto_mix`` and kept by ``mixed_documents``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.tables import numbered_copies, stored

RANK_BITS, STEP = 48, 12
MOST = 3                   # times a document may be taken
POWER = 0.5                # of the size, in a document's inclusion probability
SPACES = " \t\n\x0b\x0c\r"
BROADCAST_SOURCES = 100_000            # sources (about 100 bytes each) up to which their table is broadcast


def word_counts(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, src, h, size): words and draw hash of every row; src sorts by code point, null last."""
    keys = row_keys(df, id_col, text_col, source_col)
    return df.select(df[id_col].alias("id"), df[source_col].alias("source"), *[c.alias(k) for k, c in keys.items()])


def targets(rows: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(src, source_size, target): the sources' shares of all words, capped and reshared.

    With caps c and weights w, the common level is the largest of
    (words - caps before) / (weights before left out), sources in order of c / w.
    """
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy("src")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(most))
    up = Window.orderBy(F.col("cap") / F.col("w"), "src").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    left = (F.sum("source_size").over(every) - F.sum("cap").over(up) + F.col("cap")) \
        / (F.sum("w").over(every) - F.sum("w").over(up) + F.col("w"))
    return s.withColumn("level", left).withColumn("level", F.max("level").over(every)) \
        .select("src", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def row_keys(df: DataFrame, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """``src``: the source, sorting by code point with null last; ``h``: the draw hash of the row; ``size``: its words."""
    source, text = df[source_col].cast("string"), F.coalesce(df[text_col].cast("string"), F.lit(""))
    marks = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), SPACES, "")     # one letter a word
    return {"src": F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source)),
            "h": F.xxhash64(text, df[id_col]), "size": F.length(marks).cast("long")}


def drawn(rows: DataFrame, repeats: DataFrame) -> DataFrame:
    """``rows`` (with src, h) where the copies of a repeated row draw by hashes of their own."""
    if repeats.isEmpty():              # nothing to number
        return rows
    marked = rows.join(repeats.select("src", "h", F.lit(True).alias("repeated")), ["src", "h"], "left")
    copies = numbered_copies(marked.where("repeated").drop("repeated"), ["src", "h"])
    own = F.when(F.col("copy") > 0, F.xxhash64("h", "copy")).otherwise(F.col("h"))
    return marked.where("repeated IS NULL").drop("repeated") \
        .unionByName(copies.withColumn("h", own).drop("copy").select(*rows.columns))


def _own_draws(rows: DataFrame) -> DataFrame:
    repeats = repeated(rows)
    return rows if repeats.isEmpty() else stored(drawn(rows, repeats))


def repeated(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("src", "h").count().where("count > 1").select("src", "h"))


def ranks(seed: int) -> Column:
    """Order of u/(1-u) over p/(1-p), as a number of RANK_BITS bits."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "h"), 12) + 0.5) / 2.0 ** 52
    ahead = u * (1 - F.col("p"))
    return F.floor(ahead / (ahead + F.col("p") * (1 - u)) * 2.0 ** RANK_BITS).cast("long")


def chance(power: float) -> Column:
    """Inclusion probability of a row of ``size`` words under its source's ``rate``."""
    return F.least(F.lit(1.0), F.col("rate") * F.pow(F.col("size").cast("double"), F.lit(float(power))))


def rates(rows: DataFrame, shares: DataFrame, power: float) -> DataFrame:
    """(src, rate, certain): each source's rate, and the words of the documents it makes certain."""
    weight = F.col("words") * F.pow(F.col("size").cast("double"), F.lit(float(power)))
    sizes = rows.groupBy("src", "size").agg(F.sum("size").alias("words")) \
        .join(shares.where("part > 0").select("src", "left", "source_size"), "src")
    up = Window.partitionBy("src").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    longer = F.col("source_size") - F.sum("words").over(up)
    solved = sizes.withColumn("solution", F.try_divide(F.col("left") - longer, F.sum(weight).over(up)))
    rated = solved.withColumn("rate", F.max("solution").over(Window.partitionBy("src")))
    return rated.groupBy("src").agg(F.max("rate").alias("rate"),
                                    F.sum(F.when(chance(power) >= 1, F.col("words")).otherwise(0)).alias("certain"))


def source_cuts(rows: DataFrame, weights: tuple[float, ...], most: float, seed: int, power: float) -> DataFrame:
    """(src, source_size, target, whole, rate, prefix, cut): what each source takes.

    A row of the source is taken ``whole`` times, and once more if it is
    certain, or its rank is in a class below ``prefix`` or up to ``cut`` (rank, h).
    """
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.abs(each - F.round(each)) < 1e-9
    shares = stored(targets(rows, weights, most)
                    .withColumn("whole", F.when(near, F.round(each)).otherwise(F.floor(each)).cast("long"))
                    .withColumn("part", F.when(near, 0.0).otherwise(each - F.floor(each)))
                    .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")))
    shares = stored(shares.join(rates(rows, shares, power), "src", "left").fillna(0.0, ["rate"]))
    part = rows.join(shares.where("part > 0").select("src", "rate"), "src").withColumn("p", chance(power)) \
        .where("p > 0 and p < 1").withColumn("rank", ranks(seed))
    shares = shares.withColumn("want", F.col("left") - F.col("certain"))
    state = shares.where("part > 0").select("src", F.lit(0).cast("long").alias("prefix"), "want")
    for shift in (RANK_BITS - STEP, RANK_BITS - 2 * STEP):
        now = part.join(state, "src").where(F.shiftright("rank", shift + STEP) == F.col("prefix"))
        sums = now.groupBy("src", "want", F.shiftright("rank", shift).alias("class")).agg(F.sum("size").alias("w"))
        run = sums.withColumn("upto", F.sum("w").over(Window.partitionBy("src").orderBy("class")))
        hit = F.min(F.when(F.col("upto") >= F.col("want"), F.struct("class", "upto", "w", "want")))
        last = F.max(F.struct("class", "upto", "w", "want"))
        state = stored(run.groupBy("src").agg(F.coalesce(hit, last).alias("x"))
                       .select("src", F.col("x.class").alias("prefix"), (F.col("x.want") - F.col("x.upto") + F.col("x.w"))
                               .alias("want")))
    final = part.join(state, "src").where(F.shiftright("rank", RANK_BITS - 2 * STEP) == F.col("prefix"))
    order = Window.partitionBy("src").orderBy("rank", "h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = final.withColumn("upto", F.sum("size").over(order)) \
        .where(F.col("upto") - F.col("size") / 2 <= F.col("want")) \
        .groupBy("src").agg(F.max(F.struct("rank", "h")).alias("cut"))
    return stored(shares.drop("left", "part", "certain", "want").join(state.drop("want"), "src", "left").join(taken, "src", "left"))


def with_copies(rows: DataFrame, cuts: DataFrame, seed: int, power: float) -> DataFrame:
    """Rows (with src, h, size) with their source's columns and ``copies``."""
    # a row per source: broadcast only while they are few, else left to the planner
    small = cuts.count() <= BROADCAST_SOURCES
    joined = rows.join(F.broadcast(cuts) if small else cuts, "src").withColumn("p", chance(power)) \
        .withColumn("rank", ranks(seed))
    first = (F.shiftright("rank", RANK_BITS - 2 * STEP) < F.col("prefix")) | (F.struct("rank", "h") <= F.col("cut"))
    chosen = (F.col("p") >= 1) | ((F.col("p") > 0) & first)
    return joined.withColumn("copies", F.col("whole") + F.when(chosen, 1).otherwise(0))


def pareto_mix(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: tuple[float, ...] = (1, 2, 3), most: int = MOST, power: float = POWER,
               seed: int = 0) -> DataFrame:
    """(id, source, size, source_size, target, taken, copies) of every row."""
    rows = stored(word_counts(df, id_col, text_col, source_col))
    rows = _own_draws(rows)
    out = with_copies(rows, source_cuts(rows, weights, most, seed, power), seed, power)
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: tuple[float, ...] = (1, 2, 3), most: int = MOST, power: float = POWER,
               seed: int = 0) -> DataFrame:
    """The mix itself: each row of ``df`` as often as the mix takes it, all columns unchanged."""
    rows = stored(word_counts(df, id_col, text_col, source_col))
    keys = row_keys(df, id_col, text_col, source_col)
    repeats = repeated(rows)
    rows = rows if repeats.isEmpty() else stored(drawn(rows, repeats))
    own = df.select(F.struct(*df.columns).alias("row"), *[c.alias(k) for k, c in keys.items()])
    out = with_copies(drawn(own, repeats), source_cuts(rows, weights, most, seed, power), seed, power).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
