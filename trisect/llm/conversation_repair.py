"""Repair of turn order by the cheapest edits: a dynamic program with square-root checkpoints.

A repaired conversation's roles spell ``(s?(ua)+)?`` by their initials. A row is kept (cost 0), given the role that fits, user or assistant (2),
or deleted (3); blank and repeated rows must be deleted; an empty user or assistant turn may be inserted anywhere (2); a truncated row
that stays costs 1. The audit is the string of the edits' initials D, I, K, R; of all cheapest repairs the one with the ASCII-least audit is
taken. A pattern has four states, so a backward vector of four costs says all about the rows after a place.

Rows are sorted over all tasks and cut into blocks of at most 4096. Every block gives the costs from each state before it to each state after
it; going backward over these, the vectors at the blocks' ends are found: the checkpoints. With its checkpoint each block is walked forward by itself,
from each of the four states it may be entered in, its vectors recomputed in pieces from checkpoints of its own, about the square root of its
length apart; the edit is the first in ASCII order that is tight. Last, one pass over the blocks picks the walks that meet. A conversation of any length
is thus spread over tasks; one task sees of it one small row per block. Only ``digests`` reads a conversation in one
stream, as a SHA-256 must; it holds one row, and the audit's letters, at a time.

Faults: blank (no character but ASCII white space), duplicate (role and text seen earlier in the conversation), truncated (the last such character
is not one of ``.!?``); the first that applies counts. Null roles and texts are one space, so such a row is blank or has a role that fits nowhere. Null
turns come first; rows of one turn are ordered by a digest of role and text, so repeated rows stand together and all but one are
duplicates. A null id is one conversation. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trisect.llm.tables import stored_in_order

# Bits of a place that count within a block: blocks are 4096 rows.
BLOCK_BITS = 12
SPACE = " \t\n\v\f\r"
# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# States: nothing yet, after s, after u, after a. What may be kept in each, and what is inserted or reroled to there.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FITS = "uuau"
AFTER_FITS = (2, 2, 3, 2)
# Cheapest ends from each state: nothing, 'ua', 'a', nothing.
ENDS = (0, 2 * INSERT, INSERT, 0)
TAILS = ("", "ua", "a", "")
NEVER = 1 << 50


def text_or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults that a checksum of id and turn decides, to try a repair on.

    Of 20 remainders: 0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and question marks, 3 repeats it,
    4 makes its role user.
    """
    key = F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn"))
    rows = conversations.select(
        "conv_id", "turn", text_or_space("role").alias("role"), text_or_space("text").alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("what"),
    ).where("what != 0")
    text = F.when(F.col("what") == 1, F.lit("")).when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", ""))
    times = F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("what") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"), F.explode(times).alias("again"),
    ).drop("again")


@lru_cache(maxsize=1 << 16)
def _before(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    kind, extra = code.lower(), TRUNCATED if code.isupper() else 0
    through = []
    for state in range(4):
        costs = [DELETE + after[state]]
        if kind != "x":
            costs.append(REROLE + extra + after[AFTER_FITS[state]])
            if state in NEXT.get(kind, ()):
                costs.append(extra + after[NEXT[kind][state]])
        through.append(min(costs))
    user = min(through[2], INSERT + through[3])
    assistant = min(through[3], INSERT + through[2])
    both = min(through[0], INSERT + user), min(through[1], INSERT + user), user, assistant
    return tuple(min(c, NEVER) for c in both)


def costs_before(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """The cheapest ends from each state before a row, given those after it.

    A row's code is its role's initial, ``o`` for a role that fits nowhere, ``x`` if it must go; a capital is a truncated row.
    """
    base = min(after)
    return tuple(
        min(c + base, NEVER) for c in _before(code, tuple(NEVER if a >= NEVER else a - base for a in after))
    )


def crossing_costs(codes: str) -> list[int]:
    """The 16 costs from each state before the rows to each state after them, row by row of the matrix."""
    columns = []
    for end in range(4):
        vector = tuple(0 if s == end else NEVER for s in range(4))
        for code in reversed(codes):
            vector = costs_before(code, vector)
        columns.append(vector)
    return [columns[t][s] for s in range(4) for t in range(4)]


def across(matrix: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(min(matrix[4 * s + t] + after[t] for t in range(4)), NEVER) for s in range(4))


def _edit(code: str, state: int, here: tuple[int, ...], after: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least tight edits up to and with a row, as 'inserted:what', and the state they lead to."""
    kind, extra = code.lower(), TRUNCATED if code.isupper() else 0
    inserted = ""
    while True:
        if DELETE + after[state] == here[state]:
            return inserted + ":D", state
        if INSERT + here[AFTER_FITS[state]] == here[state]:
            inserted += FITS[state]
            state = AFTER_FITS[state]
            continue
        if state in NEXT.get(kind, ()) and extra + after[NEXT[kind][state]] == here[state]:
            return inserted + ":K", NEXT[kind][state]
        return f"{inserted}:R{FITS[state]}", AFTER_FITS[state]


def walks(codes: str, end: tuple[int, ...]) -> tuple[list[list[str]], list[int]]:
    """For each state before the rows: the edits row by row, and the state after them.

    Vectors are kept at about the square root of the rows' number, and made again between two of these while walking.
    """
    stride = isqrt(len(codes)) + 1
    kept, vector = {len(codes): end}, end
    for at in range(len(codes) - 1, -1, -1):
        vector = costs_before(codes[at], vector)
        if at % stride == 0:
            kept[at] = vector
    edits, states = [[], [], [], []], [0, 1, 2, 3]
    for first in range(0, len(codes), stride):
        last = min(first + stride, len(codes))
        vectors = [kept[last]]
        for at in range(last - 1, first - 1, -1):
            vectors.append(costs_before(codes[at], vectors[-1]))
        vectors.reverse()
        for at in range(first, last):
            for start in range(4):
                edit, states[start] = _edit(codes[at], states[start], vectors[at - first], vectors[at - first + 1])
                edits[start].append(edit)
    return edits, states


def findings(rows: DataFrame) -> DataFrame:
    """(conv_id, place, fault, code) of rows that have a place and a digest."""
    kept = F.rtrim(F.col("text"), F.lit(SPACE))
    marked = rows.select(
        "conv_id", "place", "digest", F.substring("role", 1, 1).alias("initial"), (kept == "").alias("blank"),
        (~F.right(kept, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    firsts = marked.where("NOT blank").groupBy("conv_id", "digest").agg(F.min("place").alias("place"))
    joined = marked.join(firsts.select("place", F.lit(True).alias("first")), "place", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(kind))
    return joined.withColumn("fault", fault).select("conv_id", "place", "fault", code.otherwise(kind).alias("code"))


def _emitting(table: DataFrame, added: str, make) -> DataFrame:
    """Append columns; ``make()`` returns a function from a row, as a dict, to their values. Rows keep their order."""
    fields = T._parse_datatype_string(added)
    schema = T.StructType([*table.schema.fields, *fields.fields])
    shape = to_arrow_schema(schema)

    def run(batches):
        values_of = make()
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row.update(zip(fields.fieldNames(), values_of(row), strict=True))
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    return table.mapInArrow(run, schema)


def block_edits(found: DataFrame) -> DataFrame:
    """(place, edits): what is done at each row, 'inserted before:what:inserted after'."""
    block = F.shiftrightunsigned("place", BLOCK_BITS)
    sorted_rows = F.array_sort(F.collect_list(F.struct("place", "code")))
    blocks = found.groupBy("conv_id", block.alias("block")).agg(sorted_rows.alias("rows")).select(
        "conv_id", "block", F.col("rows")[0]["place"].alias("first"),
        F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"),
    )
    blocks = _emitting(blocks, "costs array<long>", lambda: lambda row: [crossing_costs(row["codes"])])

    def backward():
        last, vector = object(), ENDS

        def values(row):
            nonlocal last, vector
            ends = row["conv_id"] != last
            if ends:
                last, vector = row["conv_id"], ENDS
            after = vector
            vector = across(row["costs"], after)
            return [list(after), ends]

        return values

    dealt = blocks.repartition("conv_id").sortWithinPartitions(F.asc("conv_id"), F.desc("block"))
    ended = _emitting(dealt, "after array<long>, ends boolean", backward).drop("costs")

    def forward_from_each_state():
        def values(row):
            edits, states = walks(row["codes"], tuple(row["after"]))
            return [[" ".join(e) for e in edits], states]

        return values

    spread = ended.repartition("conv_id", "block")
    walked = _emitting(spread, "edits array<string>, states array<int>", forward_from_each_state).drop("codes", "after")

    def meet():
        last, state = object(), 0

        def values(row):
            nonlocal last, state
            if row["conv_id"] != last:
                last, state = row["conv_id"], 0
            chosen, state = row["edits"][state], row["states"][state]
            return [chosen, TAILS[state] if row["ends"] else ""]

        return values

    dealt = walked.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    chosen = _emitting(dealt, "chosen string, tail string", meet)
    rows = chosen.select("first", "tail", F.split("chosen", " ").alias("all")).select(
        "first", "tail", F.size("all").alias("n"), F.posexplode("all").alias("at", "edit")
    )
    tail = F.when(F.col("at") == F.col("n") - 1, F.col("tail")).otherwise("")
    return rows.select((F.col("first") + F.col("at")).alias("place"), F.concat("edit", F.lit(":"), tail).alias("edits"))


def _inserted(initials: Column) -> Column:
    letters = F.filter(F.split(initials, ""), lambda x: x != "")
    return F.transform(
        letters,
        lambda x: F.struct(F.when(x == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")),
    )


def repair(conversations: DataFrame) -> DataFrame:
    """One row per row: its place in the order, fault, the edits at it, their cost, and the turns that take its place.

    ``audit`` holds the edits' initials, ``turns`` the roles and texts; both joined over a conversation's rows by ``place`` are its repair.
    """
    rows = conversations.select(
        "conv_id", F.col("turn"), text_or_space("role").alias("role"), text_or_space("text").alias("text")
    ).withColumn("digest", F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary")))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")]
    rows = stored_in_order(rows, order, "turns")
    found = findings(rows)
    done = found.join(block_edits(found), "place").select("place", "fault", F.split("edits", ":").alias("e"))
    table = rows.drop("digest").join(done, "place")
    before, what, after = F.col("e")[0], F.col("e")[1], F.col("e")[2]
    role = F.when(what == "Ru", "user").when(what == "Ra", "assistant").otherwise(F.col("role"))
    own = F.struct(role.alias("role"), F.col("text").alias("text"))
    turns = F.concat(_inserted(before), F.filter(F.array(own), lambda _: what != "D"), _inserted(after))
    act = F.substring(what, 1, 1)
    stays = F.when((what != "D") & (F.col("fault") == "truncated"), TRUNCATED).otherwise(0)
    cost = INSERT * (F.length(before) + F.length(after)) + F.when(what == "D", DELETE).when(act == "R", REROLE).otherwise(0) + stays
    inserts = lambda c: F.repeat(F.lit("I"), F.length(c))
    return table.select(
        "conv_id", "place", "turn", "role", "fault", F.concat(inserts(before), act, inserts(after)).alias("audit"),
        cost.cast("long").alias("cost"), turns.alias("turns"),
    )


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """(conv_id, place, at, role, text): the turns of the repaired conversations, in the order of place and at."""
    return repaired.select("conv_id", "place", F.posexplode("turns").alias("at", "turn")).select(
        "conv_id", "place", "at", "turn.role", "turn.text"
    )


LEGAL = {"su", "ua", "au"}
DIGESTS = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


class Tally:
    """The figures of one conversation, from its rows in order."""

    def __init__(self):
        self.lowest = self.highest = self.initial = None
        self.turns = self.illegal = self.cost = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.audit, self.hash, self.started = [], hashlib.sha256(), False

    def add(self, row: dict) -> None:
        turn = row["turn"]
        if turn is not None and turn != self.highest:
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest = turn
            self.turns += 1
        if self.initial is not None:
            self.illegal += self.initial + row["initial"] not in LEGAL
        self.initial = row["initial"]
        if row["fault"]:
            self.faults[row["fault"]] += 1
        self.cost += row["cost"]
        self.audit.append(row["audit"])
        for t in row["turns"]:
            shown = f"{t['role']}:{t['text']}"
            self.hash.update(("\n" + shown if self.started else shown).encode("utf-8", "surrogatepass"))
            self.started = True

    def values(self) -> list:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.turns
        return [gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest()]


def digests(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations``: counts of faults, cost, audit and a digest of its repair."""
    rows = repaired.select(
        "conv_id", "place", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "audit", "cost", "turns"
    )
    # A row before all others of its conversation, so that one whose rows are all gone is there too.
    marks = conversations.select("conv_id").distinct().withColumn("place", F.lit(-1).cast("long"))
    table = rows.unionByName(marks, allowMissingColumns=True)
    ordered = table.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = T.StructType([conversations.schema["conv_id"], *T._parse_datatype_string(DIGESTS).fields])
    shape = to_arrow_schema(schema)

    def batch_of(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], f.type) for i, f in enumerate(shape)], schema=shape
        )

    def run(batches):
        tally, last = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["place"] < 0:
                    if tally:
                        done.append([last, *tally.values()])
                    tally, last = Tally(), row["conv_id"]
                else:
                    tally.add(row)
            yield batch_of(done)
        if tally:
            yield batch_of([[last, *tally.values()]])

    return ordered.mapInArrow(run, schema)


def _oracle() -> str:
    """The same in SQL: a recursion from the last row to the first, over the cheapest end from each of the four states."""

    def end(cost, audit: str, text: str) -> str:
        return f"{{'c': {cost}, 'a': {audit}, 't': {text}}}"

    def turn(name: str, text: str) -> str:
        return f"chr(10) || '{name}:' || {text}"

    def inserted(name: str, state: str) -> str:
        return end(f"{INSERT} + {state}.c", f"'I' || {state}.a", f"{turn(name, chr(39) * 2)} || {state}.t")

    name_of = {"u": "user", "a": "assistant"}
    through = []
    for s in range(4):
        keeps = [k for k, steps in NEXT.items() if s in steps]
        kept = "CASE " + " ".join(f"WHEN kind = '{k}' THEN s{NEXT[k][s]}" for k in keeps) + " END"
        to = f"s{AFTER_FITS[s]}"
        options = [
            f"[{end(f'{DELETE} + s{s}.c', f'{chr(39)}D{chr(39)} || s{s}.a', f's{s}.t')}]",
            f"""CASE WHEN kind IN ({', '.join(f"'{k}'" for k in keeps)}) THEN [{
                end(f"extra + ({kept}).c", f"'K' || ({kept}).a", f"chr(10) || role || ':' || text || ({kept}).t")}] ELSE [] END""",
            f"""CASE WHEN kind <> 'x' THEN [{
                end(f"{REROLE} + extra + {to}.c", f"'R' || {to}.a", f"{turn(name_of[FITS[s]], 'text')} || {to}.t")}] ELSE [] END""",
        ]
        through.append(f"list_min({' || '.join(options)}) AS t{s}")
    ends = [end(c, f"'{'I' * len(t)}'", " || ".join(turn(name_of[x], "''") for x in t) or "''") for c, t in zip(ENDS, TAILS, strict=True)]
    return f"""
WITH RECURSIVE damaged AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
    FROM conversations
), sums AS (
    SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(k) + 1), lambda i: ord(substr(k, i, 1))::BIGINT),
        lambda crc, b: list_reduce([xor(crc, b)] || range(8),
            lambda x, n: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS what
    FROM damaged
), rows_ AS (
    SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
           CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN what = 3 THEN [0, 1] ELSE [0] END) AS again
    FROM sums WHERE what <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS i,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS kept, left(role, 1) AS initial
    FROM rows_
), faulty AS (
    SELECT *, CASE WHEN kept = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN right(kept, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
), coded AS (
    SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'o' END AS kind,
           CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra
    FROM faulty
), best AS (
    SELECT conv_id, max(i) + 1 AS i, {', '.join(f'{e} AS s{s}' for s, e in enumerate(ends))} FROM coded GROUP BY conv_id
    UNION ALL
    SELECT conv_id, i, list_min([t0, {inserted('user', 'two')}]) AS s0, list_min([t1, {inserted('user', 'two')}]) AS s1, two AS s2,
           list_min([t3, {inserted('user', 't2')}]) AS s3
    FROM (SELECT *, list_min([t2, {inserted('assistant', 't3')}]) AS two
          FROM (SELECT coded.conv_id AS conv_id, coded.i AS i, {', '.join(through)}
                FROM best JOIN coded ON coded.conv_id IS NOT DISTINCT FROM best.conv_id AND coded.i = best.i - 1))
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM coded GROUP BY conv_id
)
SELECT o.conv_id AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost,
       coalesce(s0.a, '') AS audit, sha256(coalesce(substr(s0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id AND best.i = 1
"""


ORACLE = _oracle()
