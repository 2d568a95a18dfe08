"""Repair of conversations whose turns were lost, emptied, cut, repeated or given the wrong role.

The legal orders of roles are a grammar (``GRAMMAR``: an optional system turn,
then pairs of user and assistant).  Its LR states are built once; a repair is a
generalised LR parse over the rows of a conversation that keeps several stacks
at a time.  Stacks are shared cells (state, cell below) and go by number; every
row may be kept, reroled or deleted, empty turns may be inserted anywhere, and
stacks with equal tops merge to the one of least (cost, audit).  The audit is
the line of the edits' initials; of equal costs the ASCII-least audit wins.

On Spark: equal rows are counted first, and repeats found by the first turn of
every (conversation, role, text).  The rows are range-partitioned and sorted by
(conversation, turn, role, text), so a conversation of any length is dealt over
many tasks, and cut into blocks of at most 4,096 rows.  A long block is
parsed ahead from every stack that can stand before it; a conversation's blocks are then
folded in order.  Only initials, faults and audits (a few bytes a row) travel
to the fold; texts stay where they are and meet their edits by place.

Defined results: a null conversation is one conversation of its own, a null
role or text is one space.  Rows stand by turn, nulls first; rows of one turn
by role, then the first 64 characters of the text, then its hash.  Rows with
equal role and text are repeats, the first stays.  A text without a character
besides white space is blank.  Texts of any length are read whole.  A role
whose first letter is not one of the grammar's is reroled or deleted.  An
empty table gives empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from kpiloom.llm.tables import batch_rows, partitions, stored

# rules (left side, right side); lower-case letters are role initials, the first left side is the start
GRAMMAR = (("C", ""), ("C", "P"), ("P", "Pua"), ("P", "ua"), ("P", "sua"))
GIVEN = {"a": "assistant", "u": "user"}      # roles that may be given to a row or inserted
VISIBLE = r"[^\x20\x09-\x0D]"
BLOCK_BITS = 12        # 4,096 rows of a block at most
LONG = 64              # rows from which a block is parsed ahead of the fold
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
BLANK, REPEAT, TRUNCATED = 1, 2, 3            # a row's first fault; 0 for none


class Repair(NamedTuple):
    report: DataFrame      # (conversation, gaps, blank, duplicate, truncated, illegal, cost, audit)
    turns: DataFrame       # (conversation, place, step, role, text, action), in order of place and step


# ---------------------------------------------------------------- the grammar

def lr_states(grammar) -> tuple[dict, dict]:
    """(goto, ends) of the LR(0) automaton: goto[state, symbol] = state, ends[state] = rules complete there."""
    def closed(items):
        items = set(items)
        todo = list(items)
        while todo:
            rule, dot = todo.pop()
            for k, (left, _) in enumerate(grammar):
                if grammar[rule][1][dot:dot + 1] == left and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    start = closed((k, 0) for k, (left, _) in enumerate(grammar) if left == grammar[0][0])
    number, goto, ends, todo = {start: 0}, {}, {}, [start]
    while todo:
        state = todo.pop()
        ends[number[state]] = sorted(k for k, dot in state if dot == len(grammar[k][1]))
        for symbol in sorted({grammar[k][1][dot] for k, dot in state if dot < len(grammar[k][1])}):
            after = closed((k, dot + 1) for k, dot in state if grammar[k][1][dot:dot + 1] == symbol)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            goto[number[state], symbol] = number[after]
    return goto, ends


def stack_moves(grammar=GRAMMAR) -> tuple[dict, set]:
    """(shift, accept) over numbered stacks, 0 the empty one: shift[stack, initial] = stack; stacks that may end.

    Finitely many stacks stand between two rows, as the grammar repeats on the left.
    """
    goto, ends = lr_states(grammar)
    start = grammar[0][0]

    def after(cell, symbol):
        if (cell[0], symbol) not in goto:
            return None
        cell = (goto[cell[0], symbol], cell)
        while rules := [k for k in ends[cell[0]] if grammar[k][0] != start]:
            left, right = grammar[rules[0]]
            for _ in right:
                cell = cell[1]
            cell = (goto[cell[0], left], cell)
        return cell

    cells, shift = [(0, None)], {}
    for cell in cells:
        for symbol in sorted({s for _, right in grammar for s in right if s.islower()}):
            if (new := after(cell, symbol)) is not None:
                if new not in cells:
                    cells.append(new)
                shift[cells.index(cell), symbol] = cells.index(new)
    return shift, {i for i, cell in enumerate(cells) if any(grammar[k][0] == start for k in ends[cell[0]])}


SHIFT, ACCEPT = stack_moves()
STACKS = 1 + max(SHIFT.values())
# what an insertion or a rerole makes of a stack: (initial, stack)
FITS = [[(r, SHIFT[i, r]) for r in sorted(GIVEN) if (i, r) in SHIFT] for i in range(STACKS)]


# ---------------------------------------------------------------- parsing

def with_insertions(tops: dict) -> dict:
    """Tops {stack: (cost, audit)} with those that inserted turns reach."""
    tops, todo = dict(tops), list(tops)
    while todo:
        i = todo.pop()
        cost, audit = tops[i]
        for _, j in FITS[i]:
            if j not in tops or (cost + INSERT, audit + "I") < tops[j]:
                tops[j] = (cost + INSERT, audit + "I")
                todo.append(j)
    return tops


def parsed(tops: dict, rows) -> dict:
    """Tops after the rows (initial, fault, copies)."""
    for initial, fault, copies in rows:
        ways = []
        for i, (cost, audit) in with_insertions(tops).items():
            ways.append((i, cost + DELETE, audit + "D"))
            if fault not in (BLANK, REPEAT):
                cut = CUT if fault == TRUNCATED else 0
                if (i, initial) in SHIFT:
                    ways.append((SHIFT[i, initial], cost + cut, audit + "K"))
                ways += [(j, cost + REROLE + cut, audit + "R") for _, j in FITS[i]]
        tops = {}
        for i, *way in sorted(ways, reverse=True):          # the least way to a stack comes last
            tops[i] = (way[0] + DELETE * (copies - 1), way[1] + "D" * (copies - 1))
    return tops


def edits(stack: int, rows, audit: str) -> list[str]:
    """What an audit makes of every row: k (kept), u or a (reroled), nothing (deleted); U, A: an inserted turn.

    Insertions stand with the row before them, those before the first row with the first.
    """
    out, at = [""] * len(rows), 0

    def insert(i):
        nonlocal at, stack
        while audit[at:at + 1] == "I":
            role, stack = FITS[stack][0]
            out[i] += role.upper()
            at += 1

    for i, (initial, _, copies) in enumerate(rows):
        insert(max(0, i - 1))
        if audit[at] == "K":
            out[i], stack = out[i] + "k", SHIFT[stack, initial]
        elif audit[at] == "R":
            role, stack = FITS[stack][0]
            out[i] += role
        at += copies
    insert(len(rows) - 1)
    return out


def _items(rows):
    return [(r["initial"], r["fault"], r["copies"]) for r in rows]


WAYS = pa.list_(pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
WAYS_SQL = "array<struct<before:int,after:int,cost:long,audit:string>>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _with_ways(batches):
    """Blocks with ``ways``: of a long block, for every stack before it the tops after it."""
    for batch in batches:
        ways = [[(i, j, cost, audit) for i in range(STACKS) for j, (cost, audit) in parsed({i: (0, "")}, _items(rows)).items()]
                if len(rows) >= LONG else None for rows in batch.column("rows").to_pylist()]
        named = [w and [dict(zip(("before", "after", "cost", "audit"), x)) for x in w] for w in ways]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(named, WAYS)], names=[*batch.schema.names, "ways"])


class _Conversation:
    """Fold of one conversation's blocks: the tops, the line of blocks behind each of them, and the counts."""

    def __init__(self):
        self.tops = {0: (0, "", None)}           # stack: (cost, audit, (line before, block, stack before, block's audit))
        self.count = dict.fromkeys(COUNTS, 0)
        self.turns, self.low, self.high, self.initial = 0, None, None, None

    def add(self, at, rows, ways):
        for r in rows:
            if r["turn"] is not None:
                self.turns += r["turn"] != self.high
                self.low, self.high = r["turn"] if self.low is None else self.low, r["turn"]
            self.count["blank"] += r["copies"] if r["fault"] == BLANK else 0
            self.count["duplicate"] += {BLANK: 0, REPEAT: r["copies"]}.get(r["fault"], r["copies"] - 1)
            self.count["truncated"] += r["fault"] == TRUNCATED
            self.count["illegal"] += r["copies"] - 1 + (self.initial is not None
                                                        and self.initial + r["initial"] not in ("su", "ua", "au"))
            self.initial = r["initial"]
        out = {}
        for i, (cost, audit, line) in self.tops.items():
            steps = [(w["after"], w["cost"], w["audit"]) for w in ways if w["before"] == i] if ways \
                else [(j, *way) for j, way in parsed({i: (0, "")}, _items(rows)).items()]
            for j, more, tail in steps:
                if j not in out or (cost + more, audit + tail) < out[j][:2]:
                    out[j] = (cost + more, audit + tail, (line, at, i, tail))
        self.tops = out

    def end(self):
        """(counts, audit, edits of the blocks as (block, stack before, audit))."""
        lines = {i: top[2] for i, top in self.tops.items()}
        reached, source = with_insertions({i: top[:2] for i, top in self.tops.items()}), {}
        best = min(reached[i] for i in reached if i in ACCEPT)
        # the top that the best way comes from: insertions at the end belong to the last block
        for i, (cost, audit, _) in self.tops.items():
            tail = best[1][len(audit):]
            if best[1].startswith(audit) and set(tail) <= {"I"} and best[0] == cost + INSERT * len(tail):
                source[len(tail)] = (i, tail)
        i, tail = source[min(source)]
        line, blocks = lines[i], []
        while line:
            line, at, before, audit = line
            blocks.append((at, before, audit + tail))
            tail = ""
        self.count["cost"] = best[0]
        if self.high is not None:
            self.count["gaps"] = self.high - self.low + 1 - self.turns
        return self.count, best[1], blocks


def _fold(batches):
    """Report rows (``at`` null) and block rows (at, before, audit) of conversations whose blocks come in order."""
    names, now, state = ["conv", "at", "before", "audit", *COUNTS], None, None

    def result():
        count, audit, blocks = state.end()
        return [{"conv": now, "at": None, "before": None, "audit": audit, **count},
                *[{"conv": now, "at": a, "before": b, "audit": x, **dict.fromkeys(COUNTS)} for a, b, x in blocks]]

    kind = None
    for batch in batches:
        kind, out = batch.schema.field("conv").type, []
        for r in batch.to_pylist():
            if state is None or r["conv"] != now:
                out += result() if state else []
                now, state = r["conv"], _Conversation()
            state.add(r["at"], r["rows"], r["ways"])
        if out:
            yield _batch(out, names, kind)
    if state:
        yield _batch(result(), names, kind)


def _batch(rows, names, conv):
    types = {"conv": conv, "before": pa.int32(), "audit": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types.get(n, pa.int64())) for n in names], names=names)


def _edits(batches):
    """(place, edit) of every row of the blocks."""
    for batch in batches:
        places, out = [], []
        for r in batch.to_pylist():
            places += [x["place"] for x in r["rows"]]
            out += edits(r["before"], _items(r["rows"]), r["audit"])
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(out, pa.string())], names=["place", "edit"])


# ---------------------------------------------------------------- on Spark

def repaired(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> Repair:
    """The cheapest repair of every conversation."""
    spark = conversations.sparkSession
    space = F.lit(" ")
    rows = conversations.select(conversations[conv_col].alias("conv"), conversations[turn_col].cast("long").alias("turn"),
                                F.coalesce(conversations[role_col], space).alias("role"),
                                F.coalesce(conversations[text_col], space).alias("text"))
    placed = stored(_placed(stored(rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
                                   .withColumn("hash", F.md5(F.concat("role", F.lit(":"), "text"))))))
    blocks = placed.groupBy("conv", F.shiftright("place", BLOCK_BITS).alias("block")) \
        .agg(F.sort_array(F.collect_list(F.struct("place", "turn", "initial", "fault", "copies"))).alias("rows")) \
        .select("conv", F.col("rows")[0]["place"].alias("at"), "rows")
    conv = placed.schema["conv"]
    with batch_rows(spark, 128):
        schema = StructType([*blocks.schema.fields]).simpleString()[len("struct<"):-1]
        blocks = stored(blocks.mapInArrow(_with_ways, f"{schema},ways:{WAYS_SQL}"))
        folded = StructType([StructField("conv", conv.dataType), StructField("at", LongType()), StructField("before", IntegerType()),
                             StructField("audit", StringType()), *[StructField(n, LongType()) for n in COUNTS]])
        done = stored(blocks.repartition(partitions(spark), "conv").sortWithinPartitions("conv", "at").mapInArrow(_fold, folded))
        chosen = blocks.select("at", "rows").join(done.where("at IS NOT NULL").select("at", "before", "audit"), "at")
        edit = stored(chosen.mapInArrow(_edits, "place long, edit string"))
    step = F.posexplode(F.split(F.col("edit"), "")).alias("step", "act")
    turns = placed.join(edit.where("edit <> ''"), "place").select("conv", "place", "role", "text", step)
    role = F.when(F.col("act") == "k", F.col("role")).when(F.lower("act") == "u", F.lit(GIVEN["u"])).otherwise(F.lit(GIVEN["a"]))
    inserted = F.col("act").isin("U", "A")
    turns = turns.select(F.col("conv").alias(conv_col), "place", "step", role.alias("role"),
                         F.when(inserted, F.lit("")).otherwise(F.col("text")).alias("text"),
                         F.when(inserted, F.lit("insert")).when(F.col("act") == "k", F.lit("keep")).otherwise(F.lit("rerole"))
                         .alias("action"))
    return Repair(done.where("at IS NULL").select(F.col("conv").alias(conv_col), *COUNTS, "audit"), turns)


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with their first fault and their place in the order of all conversations."""
    firsts = rows.groupBy("conv", "role", "hash").agg(
        F.max(F.col("turn").isNull()).alias("in_null"), F.min("turn").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1") \
        .select(F.col("conv").alias("of"), "hash", "in_null", "first")
    both = rows.join(firsts, rows["conv"].eqNullSafe(firsts["of"]) & (rows["hash"] == firsts["hash"]), "left").drop(firsts["hash"])
    earlier = F.col("turn").isNotNull() & (F.col("in_null") | (F.col("first") < F.col("turn")))
    ending = F.regexp_extract("text", rf"({VISIBLE})[\x20\x09-\x0D]*+\z", 1)
    fault = F.when(~F.col("text").rlike(VISIBLE), BLANK).when(F.coalesce(earlier, F.lit(False)), REPEAT) \
        .when(~ending.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", F.left("text", F.lit(64)), "hash"]
    return both.select("conv", "turn", "role", "text", "hash", "copies", F.left("role", F.lit(1)).alias("initial"),
                       fault.alias("fault")) \
        .repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order) \
        .withColumn("place", F.monotonically_increasing_id()).drop("hash")


def digests(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conversation, sha256) of the newline-joined ``role:text`` lines of its turns.

    A hash is one chain over a conversation, so a task reads its turns in
    order; it holds one batch of them.
    """
    def hashed(batches):
        now, chain, kind = None, None, None
        for batch in batches:
            kind, ids, out = batch.schema.field(0).type, [], []
            for conv, role, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if chain is not None and conv == now:
                    chain.update(b"\n")
                else:
                    if chain is not None:
                        ids.append(now)
                        out.append(chain.hexdigest())
                    now, chain = conv, hashlib.sha256()
                chain.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(out)], names=[conv_col, "sha256"])
        if chain is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([chain.hexdigest()])], names=[conv_col, "sha256"])

    schema = StructType([StructField(conv_col, turns.schema[conv_col].dataType), StructField("sha256", StringType())])
    return turns.repartition(partitions(turns.sparkSession), conv_col).sortWithinPartitions(conv_col, "place", "step") \
        .select(conv_col, "role", "text").mapInArrow(hashed, schema)
