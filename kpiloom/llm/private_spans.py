"""Personal data in documents: identifiers of known form, and unseen ones found by their contexts.

The four known kinds are regular expressions plus a test of the match (parts
of an address, digits of a number, Luhn sum).  Their matches seed a graph of
identifiers and lexical patterns: a pattern is the words around an identifier
(one or two before, one after, or both sides), with every digit as 0.  Other
tokens that could be identifiers, those with a digit or an ``@``, are instances
of unknown kind.  In a few rounds, a pattern's confidence in a kind is the
summed score of the identifiers of that kind it extracts over all that it
extracts, and an unknown instance's score is the chance that not all patterns
that extract it err; instances above a threshold join their kind and score
patterns in the next round.  Accepted instances add spans, kinds keep theirs.

Everything is a DataFrame function.  Positions are running sums over the
lengths of the pieces between two matches, in code points.  The expressions
never re-read a character more than a bounded number of times: runs that
belong together are possessive, and a look-behind keeps a search from starting
inside a run that has failed.  Copies of a document count once in the graph,
edges are distinct (pattern, instance) pairs, and only patterns that extract
``SUPPORT`` known identifiers stay in it.

Defined results: a null or empty text has no spans.  Texts of any length are
searched whole.  Matches of one kind never overlap; those of different kinds
may.  Rows with equal id and text get equal spans, rows that share only the id
their own.  An added span never overlaps a known one of its document.  An empty
table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.tables import key_columns, original_id, stored

KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
FORMS = (
    rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # only runs of 13 to 19 digits can be cards: others are passed over whole
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
# what may be an identifier of unknown kind: a run of grouped digits, or a word with a digit or an @
DIGITS = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){5,}+"
WORD = r"(?<!\S)(?=[^\s0-9@]*+[0-9@])\S{6,}+"
UNKNOWN = f"{FORMS[3]}|{WORD}|{DIGITS}"
CONTEXT = 64           # characters on either side that hold a pattern's words
SUPPORT = 3            # known identifiers that a pattern must extract
CONFIDENCE = 0.8       # of a pattern that may add instances
ACCEPTED = 0.9         # score of an instance that joins its kind
ROUNDS = 3
CHUNK = 512
SPAN = "array<struct<kind:int,start:long,end:long>>"


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   confidence: float = CONFIDENCE, accepted: float = ACCEPTED, rounds: int = ROUNDS) -> DataFrame:
    """(id, base, spans) of every row: arrays of (kind, start, end) in code points, by kind and start.

    ``kind`` indexes ``KINDS``; ``base`` are the spans of known form, ``spans``
    those and the ones found by their contexts.
    """
    key = key_columns(docs, id_col, text_col)
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(key["id"].alias("id"), key["variant"].alias("variant"), text.alias("text"))
    for k, form in enumerate((*FORMS, UNKNOWN)):
        rows = _matches(rows, f"m{k}", form, None if k == len(FORMS) else k)
    known = F.concat(*[F.filter(F.col(f"m{k}"), _proper(k)) for k in range(len(FORMS))])
    rows = stored(rows.select("id", "variant", known.alias("known"), F.col(f"m{len(FORMS)}").alias("unknown")))
    base = F.transform("known", lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    rows = rows.withColumn("base", F.sort_array(base))
    found = _found(rows, confidence, accepted, rounds)
    more = F.coalesce("more", F.array().cast(SPAN))
    return rows.join(found, ["id", "variant"], "left") \
        .select(original_id(docs, id_col), "base", F.sort_array(F.concat("base", more)).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def _matches(rows: DataFrame, name: str, form: str, kind: int | None) -> DataFrame:
    """``rows`` with the matches of a form: (kind, start, end, value, left, right)."""
    hits, gaps = F.col(f"{name}_hits"), F.col(f"{name}_gaps")
    cut = rows.withColumn(f"{name}_hits", F.regexp_extract_all("text", F.lit(form), F.lit(0))) \
        .withColumn(f"{name}_gaps", F.when(F.size(hits) > 0, F.split("text", form, -1)))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: (F.length(g) + F.length(h)).cast("long"))
    cut = cut.withColumn(f"{name}_ends", F.when(F.size(hits) > 0, _running(steps)))
    end = F.col(f"{name}_ends")
    match = F.transform(hits, lambda h, i: F.struct(
        F.lit(kind).cast("int").alias("kind"), (end[i] - F.length(h)).alias("start"), end[i].alias("end"), h.alias("value"),
        F.right(gaps[i], F.lit(CONTEXT)).alias("left"), F.left(gaps[i + 1], F.lit(CONTEXT)).alias("right")))
    return cut.withColumn(name, match).drop(f"{name}_hits", f"{name}_gaps", f"{name}_ends")


def _running(steps: Column) -> Column:
    """Running sums of an array, chunk by chunk, so that long arrays are not copied for every element."""
    def sums(xs):
        start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<long>").alias("at"))
        return F.aggregate(xs, start, lambda s, x: F.struct(
            (s["total"] + x).alias("total"), F.concat(s["at"], F.array(s["total"] + x)).alias("at")))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int")),
                         lambda c: sums(F.slice(steps, c * CHUNK + 1, F.lit(CHUNK))))
    before = sums(F.transform(chunks, lambda c: c["total"]))["at"]
    return F.flatten(F.zip_with(chunks, before, lambda c, b: F.transform(c["at"], lambda x: x + b - c["total"])))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _proper(kind: int):
    """The test of a match of this kind."""
    def small(part):
        return (F.length(F.ltrim(part, F.lit("0"))) <= 3) & (F.substring(F.concat(F.lit("00"), part), -3, 3).cast("int") <= 255)

    def luhn(value):
        doubled = F.transform(F.split(F.reverse(_digits(value)), ""),
                              lambda d, i: F.when(i % 2 == 0, d.cast("int"))
                              .otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
        return F.aggregate(doubled, F.lit(0), lambda n, d: n + d) % 10 == 0

    return {
        "email": lambda m: F.lit(True),
        "ip": lambda m: F.forall(F.split(m["value"], r"\."), small),
        "card": lambda m: luhn(m["value"]),
        "phone": lambda m: F.length(_digits(m["value"])).between(9, 15),
    }[KINDS[kind]]


def _found(rows: DataFrame, confidence: float, accepted: float, rounds: int) -> DataFrame:
    """(id, variant, more): the spans that patterns add, of documents that have any."""
    mentions = stored(_mentions(rows))
    edges = mentions.select(F.explode(_patterns()).alias("pattern"), "value", "kind").distinct()
    seeds = edges.where("kind IS NOT NULL").groupBy("pattern", "kind").count().where(F.col("count") >= SUPPORT)
    edges = stored(edges.join(seeds.select("pattern").distinct(), "pattern", "left_semi"))
    links = edges.select("pattern", "value").distinct()
    totals = links.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    known = edges.where("kind IS NOT NULL").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    unseen = edges.where("kind IS NULL").select("pattern", "value").join(known.select("value").distinct(), "value", "left_anti")
    unseen, joined = stored(unseen), None
    for _ in range(rounds):
        scored = known if joined is None else known.unionByName(joined)
        trusted = links.join(scored, "value").groupBy("pattern", "kind") \
            .agg(F.sum("score").alias("hit"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= SUPPORT) \
            .join(totals, "pattern").select("pattern", "kind", (F.col("hit") / (F.col("total") + 1)).alias("conf")) \
            .where(F.col("conf") >= confidence)
        score = (1 - F.exp(F.sum(F.log(1 - F.col("conf"))))).alias("score")
        joined = stored(unseen.join(trusted, "pattern").groupBy("value", "kind").agg(score)
                        .where(F.col("score") >= accepted).groupBy("value")
                        .agg(F.max(F.struct("score", (-F.col("kind")).alias("first"))).alias("best"))
                        .select("value", (-F.col("best.first")).alias("kind"), F.col("best.score").alias("score")))
    return mentions.where("kind IS NULL").drop("kind").join(joined.select("value", "kind"), "value") \
        .groupBy("id", "variant").agg(F.collect_set(F.struct("kind", "start", "end")).alias("more"))


def _mentions(rows: DataFrame) -> DataFrame:
    """Identifiers with their contexts: the known ones, and the unknown ones that overlap none; copies once."""
    every = rows.select("id", "variant", F.inline(F.concat("known", "unknown"))).distinct()
    is_known = F.col("kind").isNotNull()
    document = Window.partitionBy("id", "variant")
    reach = F.max(F.when(is_known, F.col("end"))).over(document.orderBy("start"))
    follows = F.min(F.when(is_known, F.col("start"))).over(document.orderBy(F.col("start").desc()))
    clear = (F.coalesce("reach", F.lit(-1)) <= F.col("start")) & (F.coalesce("follows", F.col("end")) >= F.col("end"))
    return every.withColumns({"reach": reach, "follows": follows}).where(is_known | clear).drop("reach", "follows") \
        .withColumn("value", F.lower("value"))


def _patterns() -> Column:
    """The patterns of a mention; those whose words are missing are left out."""
    def words(side):
        return F.split(F.regexp_replace(F.lower(F.trim(F.regexp_replace(side, r"\s+", " "))), "[0-9]", "0"), " ")
    left, right = words(F.col("left")), words(F.col("right"))
    one, two, after = F.try_element_at(left, F.lit(-1)), F.try_element_at(left, F.lit(-2)), F.try_element_at(right, F.lit(1))
    one, two, after = [F.nullif(w, F.lit("")) for w in (one, two, after)]
    slot = F.lit(" _ ")
    return F.array_compact(F.array(F.concat(one, slot), F.concat(two, F.lit(" "), one, slot), F.concat(slot, after),
                                   F.concat(one, slot, after)))
