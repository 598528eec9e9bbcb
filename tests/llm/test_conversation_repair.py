import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from compare import differences, oracle_connection
from llm.conftest import SF
from pyspark.sql import functions as F

from trisect.llm import conversation_repair as repairs
from trisect.llm.queries import ORACLE, QUERIES


def shown(x):
    return " " if x is None else str(x)


def damaged_plainly(rows):
    out = []
    for conv, turn, role, text in rows:
        what = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(conv, turn, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1)
    return out


def best_plainly(items):
    """Cost, audit and turns of the cheapest repair, ASCII-least: all suffixes compared as (cost, audit)."""
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(None)
    def best(i, state, inserts):
        found = []
        if i == len(items):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            role, text, fault = items[i]
            cost, audit, turns = best(i + 1, state, 0)
            found.append((3 + cost, "D" + audit, turns))
            if fault not in ("blank", "duplicate"):
                stays = 1 if fault == "truncated" else 0
                for letter, kept, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    to = follows[state].get(kept[:1])
                    if to:
                        cost, audit, turns = best(i + 1, to, 0)
                        found.append((price + stays + cost, letter + audit, ((kept, text), *turns)))
        if inserts < 3:
            for initial in "ua":
                if initial in follows[state]:
                    cost, audit, turns = best(i, initial, inserts + 1)
                    found.append((2 + cost, "I" + audit, ((names[initial], ""), *turns)))
        return min(found) if found else (10**9, "", ())

    return best(0, "", 0)


def expected(rows, ids):
    out = {}
    for conv in ids:
        mine = [r[1:] for r in rows if r[0] == conv]
        md5 = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, md5(r)))
        items, seen = [], set()
        for _, role, text in mine:
            kept = text.strip(" \t\n\v\f\r")
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else None
            seen.add((role, text))
            items.append((role, text, fault))
        cost, audit, turns = best_plainly(tuple(items))
        numbers = {r[0] for r in mine if r[0] is not None}
        out[conv] = (
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *(sum(f == x for *_, f in items) for x in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(items, items[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
        )
    return out


def found(table, conversations):
    rows = repairs.digests(repairs.repair(table), conversations).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_op12(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_checkpoint_repair"](spark, SF).collect()}
    assert result == expected(damaged_plainly(rows), {r[0] for r in rows})


def test_op12_equals_its_twin(spark):
    name = "op12_checkpoint_repair"
    assert differences(QUERIES[name](spark, SF).toPandas(), oracle_connection(SF).sql(ORACLE[name]).df()) is None


TEXTS = ["Hello.", "What?", "no end", "", " \n", None, "Done! ", "more\t", "é"]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "User", "ú"]


def made_rows(seed, convs=40):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for turn in range(rng.randrange(0, 14)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None]), rng.choice(ROLES), rng.choice(TEXTS) or rng.choice(TEXTS)))
    return rows + rows[:9]


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_random_conversations(spark, monkeypatch, bits):
    monkeypatch.setattr(repairs, "BLOCK_BITS", bits)
    rows = made_rows(bits)
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    clash = table.withColumns({c: F.lit("x") for c in ("place", "digest", "fault", "code", "block", "what", "again", "audit", "n", "at", "e")})
    ids = {r[0] for r in rows}
    plain = [(c, t, shown(r), shown(x)) for c, t, r, x in rows]
    assert found(clash, clash) == expected(plain, ids)
    assert found(repairs.damaged(clash), clash) == expected(damaged_plainly(rows), ids)


def test_turns_spell_the_pattern(spark):
    table = spark.createDataFrame(made_rows(5), "conv_id long, turn int, role string, text string")
    turns = repairs.repaired_turns(repairs.repair(table)).orderBy("conv_id", "place", "at").collect()
    spelled = {}
    for r in turns:
        spelled[r.conv_id] = spelled.get(r.conv_id, "") + r.role[0]
    assert spelled and all(re.fullmatch("s?(ua)+", s) for s in spelled.values())


def test_one_long_conversation_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repairs, "BLOCK_BITS", 4)
    rng = random.Random(1)
    rows = [(7, t, rng.choice(ROLES[:5]), f"{rng.randrange(900)} {'.' if rng.random() < 0.8 else 'x'}") for t in range(500)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    assert found(table, table) == expected(rows, {7})


def test_nothing_and_very_long_texts(spark):
    schema = "conv_id long, turn int, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert found(empty, empty) == {}
    rows = [(1, 0, "user", "w " * 500_000 + "?"), (1, 1, "assistant", "x" * 1_000_000), (2, None, None, None)]
    table = spark.createDataFrame(rows, schema)
    plain = [(c, t, shown(r), shown(x)) for c, t, r, x in rows]
    assert found(table, table) == expected(plain, {1, 2})
    gone = table.where("conv_id = 2")
    assert found(gone, table)[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
