"""Conversation structure repair: the cheapest edits that make roles alternate, found by a recursion over turns.

A conversation is its rows by turn number (nulls first; rows of one number in the order of a digest of role and text). Its roles
shall read `(s?(ua)+)?` by initials: nothing, or an optional system turn and pairs of user and assistant. Edits: Keep a turn
(free), Rerole it to user or assistant, Delete it (must for blank and repeated turns), Insert an empty user or assistant turn
anywhere; a truncated turn that stays costs extra. Costs add up; of equally cheap audits (the edits' initials in order) the
ASCII-least counts. Which role a rerole or an insert gives follows from the grammar state, so an audit fixes the repair.

What is kept for a conversation is, by grammar state before (f) and after (t), the least cost and audit. Two such tables of
neighbouring stretches fold into one, and a turn is the smallest stretch, so any stretch can be solved before its neighbours:

1. turns without their texts (initial, faults, digest) are sorted over all tasks; a turn is repeated if an earlier one has its digest,
   which is a minimum by digest joined back by row number;
2. they are dealt out by hash of (conversation, sorted part). Tasks run a DuckDB recursion over batches of whole stretches of SEGMENT
   turns at most; each recursion advances one turn in all of them and keeps the least (cost, audit) of each pair of states;
3. the same recursion folds the stretches of a part, in that task, and then the parts of a conversation, dealt out by conversation.

So a conversation that holds a third of all rows is solved in as many tasks as the sort dealt it to. Only texts of the repaired turns
and their digest, which is one stream by its nature, are read in one task a conversation: row by row, sorted by Spark, with the
conversation's audit in memory. Texts are shuffled once.

Edge cases: null roles and texts count as one space; roles with other initials than s, u and a can be reroled or deleted; a
null turn comes first; a null conv_id is a conversation; a conversation of which nothing is left (or that is only in `all_ids`)
has zeros, an empty audit and the digest of the empty text; repeated rows are duplicates; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataforge.llm.common import written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Grammar states: nothing yet, after system, after user, after assistant. From each, the state that an insert or a rerole leads to.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
OTHER = len(INITIALS)
#: Faults of a turn, in the order in which the first counts.
SOUND, BLANK, REPEATED, CUT_OFF = range(4)
#: Inserts that end a conversation in each state.
ENDING = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
SEGMENT = 256
#: Rows that a recursion takes at once.
BATCH = 20_000
PART = 1 << 33
FILLED = "[^\\x20\\x09-\\x0D]"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def moves() -> list[tuple[int, int, int, int, str]]:
    """(code of initial and fault, state before, state after, cost, audit) of one turn, with inserts before it where they pay."""
    least: dict[tuple[int, int, int], tuple[int, str]] = {}
    for initial in range(OTHER + 1):
        for fault in (SOUND, BLANK, REPEATED, CUT_OFF):
            for before in range(4):
                at = before
                for inserts in range(3):
                    edits = [(at, DELETE, "D")]
                    if fault in (SOUND, CUT_OFF):
                        extra = TRUNCATED if fault == CUT_OFF else 0
                        edits.append((NEXT[at], REROLE + extra, "R"))
                        fits = at == NOTHING if initial == SYSTEM - 1 else initial != OTHER and NEXT[at] == initial + 1
                        if fits:
                            edits.append((initial + 1, KEEP + extra, "K"))
                    for after, cost, letter in edits:
                        key, found = (4 * initial + fault, before, after), (INSERT * inserts + cost, "I" * inserts + letter)
                        least[key] = min(least.get(key, found), found)
                    at = NEXT[at]
    return [(*key, *found) for key, found in sorted(least.items())]


#: steps(g, i, s, t, cost, audit): what step i of group g leads to; starts(g, f): states to begin with.
FOLD = """
    WITH RECURSIVE path AS (
        SELECT g, f, 0 AS i, f AS s, {'cost': 0::BIGINT, 'audit': ''} AS least FROM starts
        UNION ALL
        SELECT path.g, path.f, path.i + 1, steps.t, min({'cost': path.least.cost + steps.cost, 'audit': path.least.audit || steps.audit})
        FROM path JOIN steps ON steps.g = path.g AND steps.i = path.i AND steps.s = path.s
        GROUP BY path.g, path.f, path.i, steps.t
    )
    SELECT g, f, s AS t, least.cost AS cost, least.audit AS audit FROM path JOIN (SELECT g, max(i) + 1 AS i FROM steps GROUP BY g) USING (g, i) ORDER BY g, f, t
"""
TURN_STEPS = "SELECT turns.g, turns.i, moves.s, moves.t, moves.cost, moves.audit FROM turns JOIN moves USING (code)"


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole groups g of about BATCH rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        g = batch.column("g").to_numpy(zero_copy_only=False)
        rows = sum(b.num_rows for b in held)
        if not len(g):
            continue
        starts = np.flatnonzero(np.concatenate([[not held or held[-1].column("g")[-1].as_py() != g[0]], g[1:] != g[:-1]]))
        done = 0
        for at in starts.tolist():
            if rows + at - done >= BATCH:
                held.append(batch.slice(done, at - done))
                yield pa.Table.from_batches(held)
                held, rows, done = [], 0, at
        held.append(batch.slice(done))
    if held:
        yield pa.Table.from_batches(held)


def _folding(schema: pa.Schema, kept: list[str], turns: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Folds the steps of each group g; kept are columns that a group's rows share. Turns are steps by their code; other steps are
    rows of their own, and their groups begin with the states that their first step begins with."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        con.execute("CREATE TABLE moves (code INTEGER, s INTEGER, t INTEGER, cost BIGINT, audit VARCHAR)")
        con.executemany("INSERT INTO moves VALUES (?, ?, ?, ?, ?)", moves())
        for table in _whole_groups(batches):
            g = table.column("g").to_numpy()
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            number = np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]).astype(np.int64)]))
            light = table.drop_columns(["g", *kept]).append_column("g", pa.array(number))
            con.register("turns" if turns else "steps", light)
            if turns:
                con.execute(f"CREATE OR REPLACE TEMP VIEW steps AS {TURN_STEPS}")
                con.execute("CREATE OR REPLACE TEMP VIEW starts AS SELECT g, f FROM turns, (VALUES (0), (1), (2), (3)) AS states (f) WHERE i = 0 AND (f = 0 OR NOT fresh)")
            else:
                con.execute("CREATE OR REPLACE TEMP VIEW starts AS SELECT DISTINCT g, s AS f FROM steps WHERE i = 0")
            found = con.sql(FOLD).to_arrow_table()
            con.unregister("turns" if turns else "steps")
            of = table.select(kept).take(pa.array(first[found.column("g").to_numpy()]))
            whole = pa.table([*of.columns, *(found.column(c) for c in ("f", "t", "cost", "audit"))], [*kept, "s", "t", "cost", "audit"])
            yield from whole.select(schema.names).cast(schema).to_batches()

    return fold


def _digest() -> F.Column:
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))


def _turns(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def _placed(turns: DataFrame) -> DataFrame:
    """Turns without texts in their order: seq is a row's number over all, run the number of the first of the conversation in its
    sorted part."""
    truncated = ~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    facts = _turns(turns).select("conv_id", "turn", F.position(F.substring("role", 1, 1), F.lit(INITIALS)).alias("initial"), (~F.col("text").rlike(FILLED)).alias("blank"), truncated.alias("truncated"), _digest().alias("digest"), F.substring("role", 1, 1).alias("letter"))
    facts = facts.withColumn("initial", F.when((F.col("initial") > 0) & (F.col("letter") != ""), F.col("initial") - 1).otherwise(OTHER)).drop("letter")
    ordered = written(facts.orderBy("conv_id", "turn", "digest").withColumn("seq", F.monotonically_increasing_id()), "turns")
    firsts = ordered.filter("not blank").groupBy("conv_id", "digest").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("first"))
    known = ordered.join(firsts, "seq", "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), REPEATED).when(F.col("truncated"), CUT_OFF).otherwise(SOUND)
    by_run = Window.partitionBy("conv_id", F.shiftright("seq", 33)).orderBy("seq")
    return known.select(
        "conv_id", "turn", "seq", "initial", fault.alias("fault"), (F.row_number().over(by_run) - 1).cast("long").alias("at"),
        F.lag("initial").over(by_run).alias("initial_before"), F.lag("turn").over(by_run).alias("turn_before"),
    ).withColumn("run", F.col("seq") - F.col("at"))


def _counts(placed: DataFrame) -> DataFrame:
    """Of each conversation: gaps, faults, illegal neighbours. Parts are summed first, then joined at their ends."""
    def illegal(before: F.Column, after: F.Column) -> F.Column:
        """su, ua and au are legal."""
        legal = ((before == SYSTEM - 1) & (after == USER - 1)) | ((before == USER - 1) & (after == ASSISTANT - 1)) | ((before == ASSISTANT - 1) & (after == USER - 1))
        return (before.isNotNull() & ~legal).cast("long")

    def new(before: F.Column, turn: F.Column) -> F.Column:
        return (turn.isNotNull() & ~turn.eqNullSafe(before)).cast("long")

    ends = F.struct("seq", "initial", "turn")
    runs = placed.groupBy("conv_id", "run").agg(
        *(F.count_if(F.col("fault") == k).alias(name) for k, name in ((BLANK, "blank"), (REPEATED, "duplicate"), (CUT_OFF, "truncated"))),
        F.sum(illegal(F.col("initial_before"), F.col("initial"))).alias("illegal"), F.sum(F.when(F.col("at") > 0, new(F.col("turn_before"), F.col("turn"))).otherwise(0)).alias("turns"),
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.min(ends).alias("head"), F.max(ends).alias("tail"),
    )
    last = F.lag("tail").over(Window.partitionBy("conv_id").orderBy("run"))
    joined = runs.withColumn("last", last).withColumn("illegal", F.col("illegal") + illegal(F.col("last.initial"), F.col("head.initial"))).withColumn("turns", F.col("turns") + new(F.col("last.turn"), F.col("head.turn")))
    whole = joined.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")), F.min("low").alias("low"), F.max("high").alias("high"))
    return whole.select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps"), *COUNTS[1:])


def _solved(placed: DataFrame) -> DataFrame:
    """conv_id, cost and audit of the cheapest edits."""
    spark = placed.sparkSession
    key = placed.schema["conv_id"]

    def folding(kept: dict[str, T.DataType], turns: bool):
        fields = [T.StructField(k, v) for k, v in kept.items()] + [T.StructField("s", T.IntegerType()), T.StructField("t", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = T.StructType(fields)
        return _folding(to_arrow_schema(schema), list(kept), turns), schema

    ids = {"conv_id": key.dataType, "run": T.LongType()}
    stretch = F.col("at") - F.col("at") % SEGMENT
    turns = placed.select(
        "conv_id", "run", stretch.alias("segment"), (F.col("run") + stretch).alias("g"), (F.col("at") % SEGMENT).cast("int").alias("i"), (4 * F.col("initial") + F.col("fault")).cast("int").alias("code"),
        ((F.col("at") < SEGMENT) & (F.col("run") % PART > 0)).alias("fresh"),  # begins its conversation: an earlier part of it would be right before
    )
    segments = turns.mapInArrow(*folding({**ids, "segment": T.LongType()}, True))
    runs = segments.select("conv_id", "run", F.col("run").alias("g"), (F.col("segment") / SEGMENT).cast("int").alias("i"), "s", "t", "cost", "audit").mapInArrow(*folding(ids, False))
    by_conversation = Window.partitionBy("conv_id")
    parts = runs.withColumn("g", F.min("run").over(by_conversation)).withColumn("i", F.dense_rank().over(by_conversation.orderBy("run")) - 1)
    parts = parts.filter(f"i > 0 or s = {NOTHING}").sortWithinPartitions("g", "i")
    ends = parts.select("conv_id", "g", "i", "s", "t", "cost", "audit").mapInArrow(*folding({"conv_id": key.dataType}, False))
    ending = F.create_map(*(F.lit(x) for pair in ENDING.items() for x in pair))[F.col("t")]
    return ends.select("conv_id", (F.col("cost") + INSERT * F.length(ending)).alias("cost"), F.concat("audit", ending).alias("audit"))


def solutions(turns: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation, those of all_ids too."""
    placed = _placed(turns)
    typed = turns.schema["conv_id"].dataType
    none = F.lit(None)
    parts = _counts(placed).select("conv_id", *COUNTS, none.cast("struct<cost:long,audit:string>").alias("least"))
    parts = parts.unionByName(_solved(placed).select("conv_id", *(none.cast("long").alias(c) for c in COUNTS), F.struct("cost", "audit").alias("least")))
    if all_ids is not None:
        parts = parts.unionByName(all_ids.select(F.col("conv_id").cast(typed)).distinct().select("conv_id", *(none.cast("long").alias(c) for c in COUNTS), none.cast("struct<cost:long,audit:string>").alias("least")))
    whole = parts.groupBy("conv_id").agg(*(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in COUNTS), F.min("least").alias("least"))
    return whole.select("conv_id", *COUNTS, F.coalesce("least.cost", F.lit(0)).alias("cost"), F.coalesce("least.audit", F.lit("")).alias("audit"))


class Walk:
    """Follows an audit through the turns of its conversation and gives (edit, role, text) of all edits as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def inserts(self) -> Iterator[tuple[str, str | None, str | None]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield "I", ROLES[self.state], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str | None, str | None]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            yield "D", None, None
        elif edit == "R":
            self.state = NEXT[self.state]
            yield "R", ROLES[self.state], text
        else:
            self.state = INITIALS.index(role[0]) + 1
            yield "K", role, text


def _walked(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """Conversations' audits, each before its turns with their texts, dealt out by conversation and sorted."""
    rows = _turns(turns)
    rows = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), *(F.lit(None).cast("long").alias(c) for c in (*COUNTS, "cost")), "turn", _digest().alias("digest"), "role", "text")
    heads = solved.select("conv_id", "audit", *COUNTS, "cost", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "digest")


def _streaming(emit: str, names: list[str]):
    """turns: every edit as a row; digests: the head's columns and the digest of the repaired text, kept as a running hash."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, head, position, running = None, None, 0, None

        def taken(edits) -> None:
            nonlocal position
            for edit, role, text in edits:
                if emit == "turns":
                    out.append((head[0], position, edit, role, text))
                    position += 1
                elif role is not None:
                    running.update(f"{chr(10) if position else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    position += 1

        def ended() -> None:
            if walk is not None:
                taken(walk.inserts())
                if emit == "digests":
                    out.append((*head, running.hexdigest()))

        def table(schema: pa.Schema) -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            types = [schema.field("conv_id").type] + ([pa.int64(), pa.string(), pa.string(), pa.string()] if emit == "turns" else [*[pa.int64()] * (len(names) - 3), pa.string(), pa.string()])
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        schema = None
        for batch in batches:
            out, schema = [], batch.schema
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "audit", *COUNTS, "cost", "role", "text")]
            for conv, audit, *numbers, role, text in zip(*columns, strict=True):
                if audit is not None:
                    ended()
                    walk, head, position, running = Walk(audit), (conv, *numbers, audit), 0, hashlib.sha256()
                else:
                    taken(walk.turn(role, text))
            yield table(schema)
        if schema is not None:
            out = []
            ended()
            yield table(schema)

    return stream


def repaired_turns(turns: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """conv_id, position, edit (K, R, D, I), role, text: every edit in order; deleted turns have neither role nor text."""
    solved = solutions(turns, all_ids)
    key = turns.schema["conv_id"].dataType.simpleString()
    return _walked(turns, solved).mapInArrow(_streaming("turns", ["conv_id", "position", "edit", "role", "text"]), f"conv_id {key}, position long, edit string, role string, text string")


def repaired_digests(turns: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    solved = solutions(turns, all_ids)
    key = turns.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *COUNTS, "cost", "audit", "repaired_sha256"]
    return _walked(turns, solved).mapInArrow(_streaming("digests", names), f"conv_id {key}, " + ", ".join(f"{c} long" for c in (*COUNTS, "cost")) + ", audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that the query looks for, by crc32 of `conv_id:turn` modulo 20 (nulls being one space): 0 drops the row,
    1 empties its text, 2 takes out its end marks, 3 repeats it, 4 makes its role user."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(F.concat(filled[0], F.lit(":"), filled[1]).cast("binary")) % 20).alias("_fault"))
    fault = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    return repaired_digests(damaged(conversations), conversations)


def damaged_and_repaired_sql() -> str:
    """The same for DuckDB: crc32 by its polynomial, one recursion over all conversations."""
    polynomial, full = 3988292384, 4294967295
    table = ", ".join(f"({c}, {s}, {t}, {cost}, '{audit}')" for c, s, t, cost, audit in moves())
    return f"""
    WITH RECURSIVE keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    faulted AS (SELECT conv_id, turn, role, text, xor({full}, list_reduce(list_prepend({full}, list_transform(string_split(k, ''), lambda c: CAST(unicode(c) AS BIGINT))),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, {polynomial} * (x & 1) + z)))) % 20 AS f FROM keyed),
    damaged AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, f
                FROM faulted, (VALUES (0), (1)) AS copies (copy) WHERE f <> 0 AND (copy = 0 OR f = 3)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS i FROM damaged),
    coded AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN {BLANK} WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN {REPEATED}
                     WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN {CUT_OFF} ELSE {SOUND} END AS fault,
                     CASE role[1:1] WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE {OTHER} END AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ranked),
    moves (code, s, t, cost, audit) AS (VALUES {table}),
    path AS (
        SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, {{'cost': 0::BIGINT, 'audit': ''}} AS least FROM (SELECT DISTINCT conv_id FROM coded)
        UNION ALL
        SELECT path.conv_id, path.i + 1, moves.t, min({{'cost': path.least.cost + moves.cost, 'audit': path.least.audit || moves.audit}})
        FROM path JOIN coded ON coded.conv_id IS NOT DISTINCT FROM path.conv_id AND coded.i = path.i + 1 JOIN moves ON moves.code = 4 * coded.initial + coded.fault AND moves.s = path.s
        GROUP BY path.conv_id, path.i, moves.t),
    counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK}) AS blank, count(*) FILTER (fault = {REPEATED}) AS duplicate,
                       count(*) FILTER (fault = {CUT_OFF}) AS truncated, count(*) FILTER (before || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM coded GROUP BY conv_id),
    solved AS (SELECT conv_id, min({{'cost': least.cost + CASE s WHEN {SYSTEM} THEN {2 * INSERT} WHEN {USER} THEN {INSERT} ELSE 0 END, 'audit': least.audit || CASE s WHEN {SYSTEM} THEN 'II' WHEN {USER} THEN 'I' ELSE '' END}}) AS least
               FROM path JOIN counted USING (conv_id) WHERE i = n GROUP BY conv_id),
    letters AS (SELECT conv_id, unnest(string_split(least.audit, '')) AS edit, generate_subscripts(string_split(least.audit, ''), 1) AS p FROM solved WHERE least.audit <> ''),
    placed AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS i FROM letters),
    roled AS (SELECT placed.conv_id, p, edit, text, CASE WHEN edit = 'K' THEN role END AS role, row_number() OVER (PARTITION BY placed.conv_id ORDER BY p) AS q,
                     max(CASE WHEN edit = 'K' AND role[1:1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY placed.conv_id) AS system
              FROM placed LEFT JOIN coded ON coded.conv_id = placed.conv_id AND coded.i = placed.i AND edit <> 'I' WHERE edit <> 'D'),
    lines AS (SELECT conv_id, q, coalesce(role, CASE WHEN (q - system) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM roled),
    joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY q) AS whole FROM lines GROUP BY conv_id)
    SELECT DISTINCT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           coalesce(least.cost, 0) AS cost, coalesce(least.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
    FROM conversations c LEFT JOIN counted USING (conv_id) LEFT JOIN solved USING (conv_id) LEFT JOIN joined USING (conv_id)
    """
