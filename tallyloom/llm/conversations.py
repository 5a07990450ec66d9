"""Repair of conversations by lightest derivation.

Edits of a conversation's rows, and insertions between them, are to give role initials of the form (s?(ua)+)?. What may follow depends on the last initial alone, so a stretch of rows is
described by items [p, q]: the lightest edits that lead from state p before the stretch to state q behind it, weighed by (cost, audit). Rules combine items: [p, q] and an edit of the next row give
[p, r]; [p, q] and the next stretch's [q, r] give [p, r]. Their functions are monotone and superior (an item weighs no less than its parts, in cost and as a longer
audit of the same rows), so Knuth's agenda pops items in the order of (cost, audit), each is final when it is popped, and the run ends at the goal item.

A conversation is cut into pieces of at most PIECE rows; a piece that is a whole conversation runs to its goal, other pieces to all their items, and items of neighbouring pieces are
combined two by two. The rows are placed by ranges of (conversation, turn, role, digest), so that one that holds a large part of all rows is spread over many tasks, which return a few strings per piece. The digest of the repaired rows of such a
conversation is sequential by its definition: the rows, placed and sorted by Spark, stream through one task that holds a batch at a time.

Ties: rows of one turn are taken by role, then by the SHA-256 of role and text. Null conversation ids form one conversation. Null turns come first; null roles and texts are read as one space. Repeated rows count as
they occur (and are duplicates). Roles are told apart by their first character; an empty role has none. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tallyloom.llm.shared import prepare, same, stash

# Last initial: none yet, s, u, a. A conversation may end in NOTHING or A.
NOTHING, S, U, A = STATES = range(4)
GOALS = (NOTHING, A)
BEFORE_USER = (NOTHING, S, A)
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# Rows that one agenda runs over.
PIECE = 256
BLANK = r"[^\x20\x09-\x0D]"
UNFINISHED = r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"

Item = tuple[int, str]


def follow(state: int) -> tuple[int, str]:
    """State and role that an inserted or renamed row brings."""
    return (A, "assistant") if state == U else (U, "user")


def edits(code: str, state: int) -> Iterator[tuple[int, str, int]]:
    """Cost, initial and next state of each edit of a row. Code: initial (s, u, a or other), in upper case if truncated; - for rows that must go."""
    yield DELETE, "D", state
    if code == "-":
        return
    extra, initial = (TRUNCATED if code.isupper() else 0), code.lower()
    yield REROLE + extra, "R", follow(state)[0]
    kept = {"s": S if state == NOTHING else None, "u": U if state in BEFORE_USER else None, "a": A if state == U else None}.get(initial)
    if kept is not None:
        yield KEEP + extra, "K", kept


def derive(codes: str, start: int, goals: tuple[int, ...], one: bool) -> dict[int, Item]:
    """Lightest items [start, q] over the rows of `codes`, q in goals; with `one`, only the first goal that the agenda reaches."""
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    done: set[tuple[int, int]] = set()
    found: dict[int, Item] = {}
    while agenda:
        cost, audit, at, state = heapq.heappop(agenda)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(codes) and state in goals:
            found[state] = cost, audit
            if one or len(found) == len(goals):
                break
        insert = follow(state)[0]
        if (at, insert) not in done:
            heapq.heappush(agenda, (cost + INSERT, audit + "I", at, insert))
        if at < len(codes):
            for more, initial, then in edits(codes[at], state):
                if (at + 1, then) not in done:
                    heapq.heappush(agenda, (cost + more, audit + initial, at + 1, then))
    return found


def spans(codes: str) -> dict[tuple[int, int], Item]:
    """All items of a piece."""
    return {(p, q): item for p in STATES for q, item in derive(codes, p, tuple(STATES), False).items()}


def combine(left: dict[tuple[int, int], Item], right: dict[tuple[int, int], Item]) -> dict[tuple[int, int], Item]:
    """Items of two neighbouring stretches: the lightest over the state between them."""
    out: dict[tuple[int, int], Item] = {}
    for (p, q), (cost, audit) in left.items():
        for r in STATES:
            if (q, r) in right:
                more, rest = right[q, r]
                if (p, r) not in out or cost + more <= out[p, r][0]:
                    item = cost + more, audit + rest
                    out[p, r] = min(out.get((p, r), item), item)
    return out


def fold(pieces: list[dict[tuple[int, int], Item]]) -> dict[tuple[int, int], Item]:
    """Items of a whole sequence, combined two by two."""
    while len(pieces) > 1:
        pieces = [combine(*pieces[k : k + 2]) if k + 1 < len(pieces) else pieces[k] for k in range(0, len(pieces), 2)]
    return pieces[0]


def repair(codes: str) -> Item:
    """Cost and audit of a whole conversation."""
    if len(codes) <= PIECE:
        return next(iter(derive(codes, NOTHING, GOALS, True).values()))
    items = fold([spans(codes[k : k + PIECE]) for k in range(0, len(codes), PIECE)])
    return min(items[NOTHING, q] for q in GOALS if (NOTHING, q) in items)


class Writer:
    """Digest of the repaired rows of one conversation, fed with its audit and its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.empty = audit, 0, NOTHING, hashlib.sha256(), True

    def put(self, role: str, text: str) -> None:
        self.digest.update((("" if self.empty else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.empty = False

    def inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state, role = follow(self.state)
            self.put(role, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = {"s": S, "u": U, "a": A}[role[0]]
            self.put(role, text)
        elif edit == "R":
            self.state, role = follow(self.state)
            self.put(role, text)

    def end(self) -> str:
        self.inserts()
        return self.digest.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that the contract describes, by crc32 of `conv_id:turn`; nulls are read as one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), (F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20).alias("_kind"))
    kind = F.col("_kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter(kind != 0).withColumn("text", text).withColumn("role", F.when(kind == 4, "user").otherwise(F.col("role")))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("_copy", copies).select("conv_id", "turn", "role", "text")


def said() -> Column:
    """Digest of role and text, which stands for both wherever the text itself is not needed."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def judged(rows: DataFrame) -> DataFrame:
    """Distinct (conversation, turn, role, said) with the number of copies, the agenda's code of the first copy (the others must go), and what the faults add up to."""
    initial, blank, cut = F.substring("role", 1, 1), ~F.col("text").rlike(BLANK), F.col("text").rlike(UNFINISHED)
    slim = rows.select("conv_id", "turn", "role", said().alias("said"), initial.alias("initial"), blank.alias("blank"), cut.alias("cut"))
    lines = stash(slim.groupBy("conv_id", "turn", "role", "said", "initial", "blank", "cut").agg(F.count("*").alias("copies")))
    # Of what is said at several turns of a conversation, the first.
    firsts = lines.groupBy("conv_id", "said").agg(F.min_by("turn", F.struct(F.col("turn").isNotNull(), "turn")).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    firsts = firsts.select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "_first", "_n")
    met = lines.join(firsts, (F.col("said") == F.col("_said")) & same(F.col("conv_id"), F.col("_conv")), "left")
    first = F.col("_n").isNull() | same(F.col("turn"), F.col("_first"))
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("o"))
    code = F.when(F.col("blank") | ~first, "-").when(F.col("cut"), F.upper(letter)).otherwise(letter)
    repeats = F.when(F.col("blank"), 0).otherwise(F.col("copies") - first.cast("long"))
    return met.select("conv_id", "turn", "role", "said", "initial", "copies", code.alias("code"), "blank", repeats.alias("n_duplicate"), (first & ~F.col("blank") & F.col("cut")).cast("long").alias("n_truncated"))


ITEMS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
STRETCH = [("stretch", pa.int64()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")), ("first", pa.string()), ("last", pa.string()), ("cost", pa.int64()), ("audit", pa.string()), ("items", ITEMS)]
STRETCH_SQL = "stretch long, blank long, duplicate long, truncated long, illegal long, first string, last string, cost long, audit string, items array<struct<p:int,q:int,cost:long,audit:string>>"


class Stretch:
    """Rows of one conversation that lie in one task."""

    def __init__(self, key: tuple):
        self.key, self.codes, self.pieces = key, [], []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, initial: str, copies: int, code: str, blank: bool, n_duplicate: int, n_truncated: int) -> None:
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += copies - 1  # a row next to itself
        self.last = initial
        self.blank += copies if blank else 0
        self.duplicate += n_duplicate
        self.truncated += n_truncated
        for k in range(copies):
            self.codes.append("-" if k else code)
            if len(self.codes) > PIECE:  # more than one piece: the first is cut off
                self.pieces.append(spans("".join(self.codes[:PIECE])))
                del self.codes[:PIECE]
                if len(self.pieces) == 64:
                    self.pieces = [fold(self.pieces)]

    def row(self) -> tuple:
        """One piece: its codes, and its repair in case it is the whole conversation. More: their items."""
        codes = "".join(self.codes)
        if self.pieces:
            cost = audit = None
            items = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in fold([*self.pieces, spans(codes)]).items()]
        else:
            cost, audit = repair(codes)
            items = [{"p": -1, "q": -1, "cost": 0, "audit": codes}]
        return (*self.key, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, cost, audit, items)


def id_kind(df: DataFrame) -> pa.DataType:
    return to_arrow_schema(df.select("conv_id").schema).field(0).type


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def stretches(lines: DataFrame) -> DataFrame:
    """A row per conversation and task: counts, the initials at both ends, and items. Ranges of the order cut a long conversation in several."""
    keys = ["conv_id", "turn", "role", "said"]
    dealt = lines.repartitionByRange(partitions(lines), *keys).sortWithinPartitions(*keys).withColumn("stretch", F.spark_partition_id().cast("long"))
    fields = [("conv_id", id_kind(lines)), *STRETCH]
    read = ["conv_id", "stretch", "initial", "copies", "code", "blank", "n_duplicate", "n_truncated"]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            for conv, stretch, *rest in zip(*(batch.column(c).to_pylist() for c in read)):
                if now is None or now.key != (conv, stretch):
                    if now is not None:
                        out.append(now.row())
                    now = Stretch((conv, stretch))
                now.add(*rest)
            if out:
                yield packed(out)
                out = []
        if now is not None:
            yield packed([now.row()])

    return dealt.select(*read).mapInArrow(run, f"conv_id {lines.schema['conv_id'].dataType.simpleString()}, {STRETCH_SQL}")


def whole_repairs(parts: DataFrame) -> DataFrame:
    """A row per conversation with rows: counts, cost and audit. Those in one piece are done; of the others, the stretches meet here, at most one for each task before."""
    order = Window.partitionBy("conv_id").orderBy("stretch")
    parts = parts.withColumn("_before", F.lag("last").over(order))
    seam = (F.col("_before").isNotNull() & ~F.concat("_before", "first").isin(*LEGAL)).cast("long")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    whole = parts.groupBy("conv_id").agg(*sums, F.sum(F.col("illegal") + seam).alias("illegal"), F.count("*").alias("_n"), F.first("cost").alias("cost"), F.first("audit").alias("audit"), F.array_sort(F.collect_list(F.struct("stretch", "items"))).alias("_parts"))
    counts = ["conv_id", "blank", "duplicate", "truncated", "illegal"]
    one = (F.col("_n") == 1) & F.col("cost").isNotNull()
    whole = stash(whole.withColumn("_parts", F.when(~one, F.col("_parts"))))
    done = whole.filter("_parts is null").select(*counts, "cost", "audit")
    fields = [("conv_id", id_kind(parts)), *((c, pa.int64()) for c in counts[1:]), ("cost", pa.int64()), ("audit", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for stretches_ in batch.column("_parts").to_pylist():
                items = fold([items_of(s["items"]) for s in stretches_])
                found.append(min(items[NOTHING, q] for q in GOALS if (NOTHING, q) in items))
            if found:
                costs, audits = (pa.array(list(c), t) for c, t in zip(zip(*found), (pa.int64(), pa.string())))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in counts), costs, audits], [n for n, _ in fields])

    return done.union(whole.filter("_parts is not null").select(*counts, "_parts").mapInArrow(run, done.schema))


def items_of(listed: list[dict]) -> dict[tuple[int, int], Item]:
    if listed[0]["p"] < 0:
        return spans(listed[0]["audit"])
    return {(i["p"], i["q"]): (i["cost"], i["audit"]) for i in listed}


def digests(rows: DataFrame, done: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256). Rows come sorted by conversation, its audit before them."""
    keys = ["conv_id", "kind", "turn", "role", "said"]
    void = {"turn": rows.schema["turn"].dataType, "role": "string", "said": "binary"}
    audits = done.select("conv_id", F.lit(0).alias("kind"), F.col("audit").alias("text"), *(F.lit(None).cast(t).alias(c) for c, t in void.items()))
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "text", "turn", "role", said().alias("said"))
    dealt = audits.unionByName(lines).repartition(partitions(rows), "conv_id").sortWithinPartitions(*keys)
    kind_of_id = id_kind(rows)

    def packed(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], kind_of_id), pa.array([d for _, d in found])], ["conv_id", "repaired_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = key = None
        for batch in batches:
            out = []
            for conv, kind, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))):
                if kind:
                    writer.row(role, text)
                else:
                    if writer is not None:
                        out.append((key, writer.end()))
                    writer, key = Writer(text), conv
            if out:
                yield packed(out)
        if writer is not None:
            yield packed([(key, writer.end())])

    return dealt.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def repair_structure(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation in (conv_id, turn, role, text)."""
    prepare(rows.sparkSession)
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", "turn", text_of("role"), text_of("text"))
    lines = judged(rows)
    done = stash(whole_repairs(stash(stretches(lines))))
    # Distinct turns first, so that a conversation with many rows is counted in parts.
    turns = lines.filter(F.col("turn").isNotNull()).select("conv_id", "turn").distinct()
    gaps = turns.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    gaps = gaps.select(F.col("conv_id").alias("_gap_id"), "gaps")
    prints = digests(rows, done).select(F.col("conv_id").alias("_print_id"), "repaired_sha256")
    out = done.join(gaps, same(F.col("conv_id"), F.col("_gap_id")), "left").join(prints, same(F.col("conv_id"), F.col("_print_id")))
    return out.select("conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after the contract's damage; those that lose all rows have zeros, no audit and the digest of nothing."""
    prepare(conversations.sparkSession)
    found = stash(repair_structure(damaged(conversations)).withColumnRenamed("conv_id", "_id"))
    every = conversations.select("conv_id").distinct().join(found, same(F.col("conv_id"), F.col("_id")), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
