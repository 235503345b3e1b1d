import heapq
import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from ledgerlift.llm import conversation_repair, registry
from ledgerlift.llm.conversation_repair import (
    matrix_of,
    power,
    repair_conversations,
    repaired_turns,
    times,
    unroll,
)

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def shortest(rows):
    """Cheapest edits of ``(role, text, fault)`` rows, ties by the audit, with what they leave.

    A shortest path over (rows used, letters written so far as the automaton's state); labels are
    (cost, audit), so the first time that the end is reached gives the answer.
    """
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, kept = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, audit, [(r, t) for r, t in kept]
        for letter, name in names.items():
            if letter in after[state]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, letter, (*kept, (name, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, kept))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in after[state]:
                    new = (cost + extra, audit + "K", i + 1, role[:1], (*kept, (role, text)))
                    heapq.heappush(heap, new)
                for letter, name in names.items():
                    if letter in after[state]:
                        new = (cost + 2 + extra, audit + "R", i + 1, letter, (*kept, (name, text)))
                        heapq.heappush(heap, new)


def plain_repair(rows):
    """The report of one conversation, from ``(turn, role, text)`` rows in order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(WHITE)
        if not bare:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, kept = shortest([(r, x, f) for (_, r, x), f in zip(rows, faults, strict=True)])
    report = (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost,
        audit,
        sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )
    return report, kept


def plain_damage(rows):
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        for _ in range(0 if kind == 0 else 2 if kind == 3 else 1):
            yield conv_id, turn, role, text


def by_conversation(rows):
    groups = {}
    for conv_id, turn, role, text in rows:
        groups.setdefault(conv_id, []).append((turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0)
    return {c: sorted(g, key=order) for c, g in groups.items()}


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in df.collect()}


def random_rows(rng, conversations, longest):
    for conv_id in range(conversations):
        turn = rng.randrange(3)
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice([1, 1, 1, 2])
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "No", "", " \n", "a b!", "c?\n", None, f"t{rng.randrange(99)}."])
            yield conv_id, turn, role, text


@pytest.mark.parametrize("piece_rows", [1, 3, 1 << 16])
def test_matches_shortest_path(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(conversation_repair, "PIECE_ROWS", piece_rows)
    rng = random.Random(piece_rows)
    rows = list(random_rows(rng, 60, 14))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = {c: plain_repair(g) for c, g in by_conversation(rows).items()}
    assert found(repair_conversations(df)) == {c: e for c, (e, _) in expected.items()}
    kept = {}
    for r in sorted(repaired_turns(df).collect(), key=lambda r: (r.conv_id, r.place)):
        kept.setdefault(r.conv_id, []).append((r.role, r.text))
    assert kept == {c: k for c, (_, k) in expected.items() if k}


def test_query_matches_shortest_path(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    groups = by_conversation(plain_damage(rows))
    expected = {c: plain_repair(groups.get(c, []))[0] for c in {r[0] for r in rows}}
    assert found(registry.queries()["op12_conversation_repair"](spark, sf_dir)) == expected


def test_long_conversation_is_cut_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PIECE_ROWS", 50)
    rng = random.Random(3)
    roles = ["user"] * 40 + ["assistant"] * 40
    rows = [(7, i, rng.choice(roles[i % 80 :] or roles), f"t{rng.randrange(10**6)}.") for i in range(900)]
    rows += [(8, i, "system", "same.") for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    expected = {c: plain_repair(g)[0] for c, g in by_conversation(rows).items()}
    assert found(repair_conversations(df)) == expected


def test_odd_rows(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "user", "x."),
        (1, None, "user", "Hi."),
        (1, None, "assistant", "Ho."),
        (2, 5, "user", "Hi."),
        (2, 5, "user", "Hi."),
        (2, 5, "user", "Hi."),
        (3, 1, "", ""),
        (4, 1, "user", "word " * 30000 + "."),
        (4, 2, "assistant", "x" * 300000),
        (5, 1, "System", "Hi."),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.withColumns({c: F.lit("x") for c in ("piece", "symbol", "audit", "n", "text_hash")})
    # Rows of one turn are ordered by role.
    ordered = sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] or ""))
    expected = {c: plain_repair(g)[0] for c, g in by_conversation(ordered).items()}
    assert found(repair_conversations(extra)) == expected
    assert repair_conversations(df.limit(0)).count() == 0
    assert repaired_turns(df.limit(0)).count() == 0


def test_conversations_without_rows_left(spark, tmp_path):
    dropped = [i for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    rows = [(i, 0, "user", "Hi.") for i in range(200)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = found(registry.queries()["op12_conversation_repair"](spark, str(tmp_path)))
    assert len(got) == 200 and dropped
    assert {got[i] for i in dropped} == {(0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}


@pytest.mark.parametrize("symbol", list("suaoSUAOdx"))
def test_powers_of_runs(symbol):
    product = power(symbol, 0)
    for count in range(1, 20):
        assert matrix_of([symbol], [count]) == product
        assert matrix_of([symbol] * count, [1] * count) == product
        product = times(product, power(symbol, 0))
    end = conversation_repair._END
    one_by_one = unroll(symbol * 5000, [1] * 5000, 0, end, True)
    assert unroll(symbol, [5000], 0, end, True) == one_by_one
