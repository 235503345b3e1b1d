"""Conversations repaired by the cheapest edits, with runs of equal symbols advanced by powers.

A row's symbol is its role's initial with its fault: clean, truncated, or to be deleted. Four states
say what the repaired roles end in (nothing, system, user, assistant), and a symbol is a min-plus
matrix over them: the least cost of the edits between two states, insertions before the row included.
Equal consecutive symbols are a run, which advances by the cached binary powers of its matrix. Read
backwards these give the cost that is still to go, and read forwards the choices: in each state the
ASCII-least edit that keeps to the least cost. Choices of a run are put together from cached halves.

Matrices are associative, so a conversation need not be in one task. Rows are dealt out by ranges of
(conversation, turn), each range is cut into pieces, and only pieces of conversations that lie in
several have their matrices multiplied up: first the costs to go after each piece, from these what
state each piece leads to from each of the four, then the choices, piece by piece. That takes one
symbol and one number a run, no texts. The texts are read once more, in order, beside the edits of
their piece; a SHA-256 is sequential by definition, so a conversation's digest is one stream, of
which a task holds one row and one piece at a time.

Defined cases: a null role or text is one space, so such a text is blank; an empty role is a role of
its own that no order allows; null turns come first and count for no gap; rows of one turn are
ordered by role and a hash of the text; equal rows are duplicates of the first; a null ``conv_id`` is a
conversation; very long texts and conversations are streamed, only the audit of a conversation is
one value; an empty table gives no rows; other columns are ignored, whatever their names. Texts of
one conversation are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from hashlib import sha256
from operator import and_

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlift.llm.common import written

#: Rows of a conversation after which a piece ends.
PIECE_ROWS = 1 << 16
#: The longest block of a run whose choices are cached, as a power of two.
TOP_POWER = 12

# Costs, and the order of the edits' initials.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
_NO_WAY = 1 << 60
#: The state after an inserted or reroled row, by the state before: the only role that may follow.
_NEXT = (USER, USER, ASSISTANT, USER)
_KEPT = {
    "s": {NONE: SYSTEM},
    "u": {NONE: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
#: Symbols of rows that have to be deleted: a duplicate and any other one.
DUPLICATE, GONE = "d", "x"
#: Cost to go when no row is left: what it takes to end in nothing or with an assistant.
_END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]


def _row_edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Edits that use up a row: initial, cost and the state after, in ASCII order."""
    edits = [("D", DELETE, state)]
    if symbol not in (DUPLICATE, GONE):
        extra = TRUNCATED if symbol.isupper() else 0
        kept = _KEPT.get(symbol.lower(), {}).get(state)
        if kept is not None:
            edits.append(("K", extra, kept))
        edits.append(("R", REROLE + extra, _NEXT[state]))
    return edits


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices."""
    return tuple(tuple(min(r[k] + b[k][q] for k in STATES) for q in STATES) for r in a)


def to_go(a: tuple, v: Vector) -> Vector:
    """Costs to go before what a matrix stands for, from those after it."""
    return tuple(min(r[k] + v[k] for k in STATES) for r in a)


@lru_cache(maxsize=None)
def power(symbol: str, exponent: int) -> tuple:
    """Matrix of ``2**exponent`` rows with this symbol."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    rows = []
    for state in STATES:
        row, at, paid = [_NO_WAY] * 4, state, 0
        for _ in range(3):  # a third insertion would only come back to an earlier state
            for _, cost, after in _row_edits(symbol, at):
                row[after] = min(row[after], paid + cost)
            at, paid = _NEXT[at], paid + INSERT
        rows.append(tuple(row))
    return tuple(rows)


def _blocks(count: int) -> list[int]:
    """Exponents of the powers of two, at most the top one, that add up to ``count``."""
    low = count & ((1 << TOP_POWER) - 1)
    return [TOP_POWER] * (count >> TOP_POWER) + [k for k in reversed(range(TOP_POWER)) if low >> k & 1]


def _level(v: Vector) -> Vector:
    """The vector less its least component: choices depend on differences alone."""
    least = min(v)
    return tuple(x - least for x in v)


@lru_cache(maxsize=1 << 14)
def _back(symbol: str, exponent: int, v: Vector) -> Vector:
    return _level(to_go(power(symbol, exponent), v))


@lru_cache(maxsize=1 << 12)
def choices(symbol: str, exponent: int, state: int, v: Vector) -> tuple[str, str, int, int]:
    """Audit, script, last state and cost of the edits for ``2**exponent`` rows with this symbol.

    ``v`` is the cost to go after them. The script says what to do with each row that has a text
    (``K``: keep, ``u`` and ``a``: rerole, ``D``: delete) and what to insert (``U``, ``A``).
    """
    if exponent:
        middle = _back(symbol, exponent - 1, v)
        audit, script, state, cost = choices(symbol, exponent - 1, state, middle)
        more, more_script, state, more_cost = choices(symbol, exponent - 1, state, v)
        return audit + more, script + more_script, state, cost + more_cost
    before = to_go(power(symbol, 0), v)
    audit = script = ""
    cost = 0
    while True:
        for edit, price, after in sorted([*_row_edits(symbol, state), ("I", INSERT, _NEXT[state])]):
            rest = before if edit == "I" else v
            if price + rest[after] == before[state]:
                break
        role = "ua"[after == ASSISTANT]
        audit, cost, state = audit + edit, cost + price, after
        if edit == "I":
            script += role.upper()
            continue
        if symbol != GONE:
            script += role if edit == "R" else edit
        return audit, script, state, cost


def matrix_of(symbols: str, counts: list[int]) -> tuple:
    """Matrix of a piece, run by run."""
    result = tuple(tuple(0 if p == q else _NO_WAY for q in STATES) for p in STATES)
    for symbol, count in zip(symbols, counts, strict=True):
        exponent = 0
        while count:
            if count & 1:
                result = times(result, power(symbol, exponent))
            count, exponent = count >> 1, exponent + 1
    return result


def unroll(
    symbols: str, counts: list[int], state: int, v: Vector, last: bool
) -> tuple[str, str, int, int]:
    """Audit, script, last state and cost of a piece that starts in ``state``; ``v`` as above.

    The last piece of a conversation also has the insertions after all rows.
    """
    blocks = [
        (symbol, exponent)
        for symbol, count in zip(symbols, counts, strict=True)
        for exponent in _blocks(count)
    ]
    after, v = [], _level(v)
    for symbol, exponent in reversed(blocks):
        after.append(v)
        v = _back(symbol, exponent, v)
    audits, scripts, cost = [], [], 0
    for (symbol, exponent), v in zip(blocks, reversed(after), strict=True):
        audit, script, state, price = choices(symbol, exponent, state, v)
        audits.append(audit)
        scripts.append(script)
        cost += price
    if last:
        added = {SYSTEM: "UA", USER: "A"}.get(state, "")
        audits.append("I" * len(added))
        scripts.append(added)
        cost += INSERT * len(added)
    return "".join(audits), "".join(scripts), state, cost


def _texts(rows: DataFrame) -> DataFrame:
    """The columns that count, without nulls where one space stands for them."""
    return rows.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))


def _by_conversation(rows: DataFrame, others: str) -> StructType:
    """``conv_id`` with its own type, and other columns."""
    return StructType([rows.schema["conv_id"], *StructType.fromDDL(others)])


def _is_blank() -> Column:
    return ~F.col("text").rlike(r"[^\x20\x09-\x0D]")


def _turns(rows: DataFrame) -> DataFrame:
    """Each different row of a conversation with its symbol and how often it is there. No texts."""
    light = _texts(rows).select(
        "conv_id",
        "turn",
        "role",
        "text_hash",
        _is_blank().alias("blank"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )
    counted = written(
        light.groupBy("conv_id", "turn", "role", "text_hash", "blank", "truncated").agg(
            F.count(F.lit(1)).alias("n")
        ),
        "turns",
    )
    # Texts said at several turns; the earliest is no duplicate.
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    said = ["conv_id", "role", "text_hash"]
    several = (
        counted.groupBy(*(F.col(c).alias(f"_{c}") for c in said))
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns"))
        .where("turns > 1")
    )
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in said))
    joined = counted.join(several, same, "left")
    repeated = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = (
        F.when(F.col("blank"), GONE)
        .when(repeated, DUPLICATE)
        .when(F.col("truncated"), F.upper(kind))
        .otherwise(kind)
    )
    return joined.select(
        *("conv_id", "turn", "role", "text_hash", "n"),
        initial.alias("initial"),
        symbol.alias("symbol"),
    )


def _counts(turns: DataFrame) -> DataFrame:
    """Gaps and faults of each conversation."""
    symbol, n = F.col("symbol"), F.col("n")
    truncated = symbol.isin("S", "U", "A", "O")
    by_turn = turns.groupBy("conv_id", "turn").agg(
        F.sum(F.when(symbol == GONE, n).otherwise(0)).alias("blank"),
        F.sum(
            F.when(symbol == DUPLICATE, n).when(symbol != GONE, n - 1).otherwise(0)
        ).alias("duplicate"),
        F.sum(truncated.cast("bigint")).alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
    )


_LEGAL = {"su", "ua", "au"}


def _pieces(turns: DataFrame) -> DataFrame:
    """Rows in order, cut into pieces of one conversation with their runs.

    A piece that may have others of its conversation in another piece is ``open`` and has its
    matrix. ``turn``, ``role`` and ``text_hash`` are those of its first row.
    """
    schema = _by_conversation(
        turns,
        "part int, piece int, turn bigint, role string, text_hash bigint, symbols string, "
        "counts array<bigint>, first string, last string, illegal bigint, matrix array<bigint>",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, conv_type = TaskContext.get().partitionId(), 0, None
        current, done = None, []

        def close(is_open: bool) -> None:
            nonlocal number, current
            if is_open or current["open"]:
                matrix = matrix_of(current["symbols"], current["counts"])
                current["matrix"] = [x for row in matrix for x in row]
            current["symbols"] = "".join(current["symbols"])
            done.append(current | {"part": part, "piece": number})
            number, current = number + 1, None

        def out() -> pa.RecordBatch:
            columns = [
                pa.array([p["conv_id"] for p in done], conv_type),
                *(
                    pa.array([p.get(name) for p in done], kind)
                    for name, kind in (
                        ("part", pa.int32()),
                        ("piece", pa.int32()),
                        ("turn", pa.int64()),
                        ("role", pa.string()),
                        ("text_hash", pa.int64()),
                        ("symbols", pa.string()),
                        ("counts", pa.list_(pa.int64())),
                        ("first", pa.string()),
                        ("last", pa.string()),
                        ("illegal", pa.int64()),
                        ("matrix", pa.list_(pa.int64())),
                    )
                ),
            ]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for conv_id, turn, role, text_hash, n, initial, symbol in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                goes_on = False
                if current and current["conv_id"] != conv_id:
                    close(False)
                elif current and current["rows"] >= PIECE_ROWS:
                    close(True)
                    goes_on = True
                if not current:
                    # The first piece of a range may go on with the last one of the range before.
                    current = {
                        "conv_id": conv_id, "turn": turn, "role": role, "text_hash": text_hash,
                        "open": goes_on or not number, "rows": 0, "symbols": [], "counts": [],
                        "first": initial, "last": None, "illegal": 0,
                    }
                elif current["last"] + initial not in _LEGAL:
                    current["illegal"] += 1
                current["illegal"] += n - 1
                current["last"] = initial
                current["rows"] += 1
                for run, count in ((symbol, 1), (GONE, n - 1)):
                    if current["symbols"] and current["symbols"][-1] == run:
                        current["counts"][-1] += count
                    elif count:
                        current["symbols"].append(run)
                        current["counts"].append(count)
            if done:
                yield out()
        if current:
            close(True)
        if done:
            yield out()

    order = ["conv_id", "turn", "role", "text_hash"]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select(*order, "n", "initial", "symbol").mapInArrow(cut, schema)


def _per_group(groups: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on each row of ``groups``; it yields the rows of ``schema`` as dictionaries."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
        kinds["array<bigint>"], kinds["array<int>"] = pa.list_(pa.int64()), pa.list_(pa.int32())
        types = pa.schema([(n, kinds[f.split()[1]]) for n, f in zip(names, schema.split(", "), strict=True)])
        for batch in batches:
            found = [row for group in batch.to_pylist() for row in work(group)]
            yield pa.RecordBatch.from_pylist(found, types)

    return groups.mapInArrow(run, schema)


def _seams(pieces: DataFrame) -> DataFrame:
    """Where a conversation has several pieces: the costs to go after each, whether it is the last,
    and whether its first row may not follow the piece before."""

    def work(group: dict) -> Iterator[dict]:
        v, parts = _END, group["parts"]
        for k in reversed(range(len(parts))):
            p = parts[k]
            seam = k > 0 and parts[k - 1]["last"] + p["first"] not in _LEGAL
            yield {
                "part": p["part"], "piece": p["piece"], "v": v,
                "is_last": k == len(parts) - 1, "seam": int(seam),
            }
            m = p["matrix"]
            v = _level(to_go([m[0:4], m[4:8], m[8:12], m[12:16]], v))

    parts = F.array_sort(F.collect_list(F.struct("part", "piece", "matrix", "first", "last")))
    several = (
        pieces.where(F.col("matrix").isNotNull())
        .groupBy("conv_id")
        .agg(parts.alias("parts"))
        .where(F.size("parts") > 1)
        .select("parts")
    )
    schema = "part int, piece int, v array<bigint>, is_last boolean, seam int"
    return written(_per_group(several, work, schema), "seams")


def _starts(pieces: DataFrame, seams: DataFrame) -> DataFrame:
    """The state that each piece with seams starts in.

    Each piece is unrolled from all four states, since which of equally cheap ways the pieces before
    it take is not known yet.
    """

    def ends(piece: dict) -> Iterator[dict]:
        found = [
            unroll(piece["symbols"], piece["counts"], s, tuple(piece["v"]), False)[2] for s in STATES
        ]
        yield {"part": piece["part"], "piece": piece["piece"], "ends": found}

    def follow(group: dict) -> Iterator[dict]:
        state = NONE
        for p in group["parts"]:
            yield {"part": p["part"], "piece": p["piece"], "start": state}
            state = p["ends"][state]

    open_pieces = pieces.join(seams, ["part", "piece"])
    led = _per_group(
        open_pieces.select("part", "piece", "symbols", "counts", "v"),
        ends,
        "part int, piece int, ends array<int>",
    )
    parts = F.array_sort(F.collect_list(F.struct("part", "piece", "ends")))
    groups = pieces.select("conv_id", "part", "piece").join(led, ["part", "piece"])
    in_order = groups.groupBy("conv_id").agg(parts.alias("parts")).select("parts")
    return _per_group(in_order, follow, "part int, piece int, start int")


def _edits(turns: DataFrame) -> DataFrame:
    """Pieces with their ``audit``, ``script``, ``cost`` and ``illegal`` pairs."""
    pieces = written(_pieces(turns), "pieces")
    seams = _seams(pieces)
    starts = written(_starts(pieces, seams), "starts")
    named = pieces.drop("matrix", "first", "last")
    planned = named.join(seams, ["part", "piece"], "left").join(starts, ["part", "piece"], "left")
    kept = ["conv_id", "part", "piece", "turn", "role", "text_hash"]
    edited = StructType.fromDDL("audit string, script string, cost bigint, illegal bigint")
    schema = StructType([*(planned.schema[c] for c in kept), *edited])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n).to_pylist() for n in ("symbols", "counts", "v", "start", "is_last")}
            found = [
                unroll(symbols, counts, start or NONE, tuple(v or _END), last is not False)
                for symbols, counts, v, start, last in zip(*columns.values(), strict=True)
            ]
            audits, scripts, _, costs = zip(*found, strict=True) if found else [[]] * 4
            illegal = [
                inside + (seam or 0)
                for inside, seam in zip(
                    batch.column("illegal").to_pylist(), batch.column("seam").to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(audits, pa.string()),
                    pa.array(scripts, pa.string()),
                    pa.array(costs, pa.int64()),
                    pa.array(illegal, pa.int64()),
                ],
                names=schema.names,
            )

    return written(planned.mapInArrow(edit, schema), "edits")


def _replay(columns: Iterator[list]) -> Iterator[tuple]:
    """Repaired rows ``(conv_id, role, text)`` in order; ``(conv_id, None, None)`` ends each one.

    Rows come sorted by conversation and place, each piece's script before its rows.
    """
    started, conv_id, script, at, seen = False, None, "", 0, None

    def inserted() -> Iterator[tuple]:
        nonlocal at
        while at < len(script) and script[at] in "UA":
            yield conv_id, "user" if script[at] == "U" else "assistant", ""
            at += 1

    for batch in columns:
        for row_conv, turn, role, text_hash, is_script, text in zip(*batch, strict=True):
            if is_script:
                yield from inserted()
                if started and row_conv != conv_id:
                    yield conv_id, None, None
                started, conv_id, script, at, seen = True, row_conv, text, 0, None
                continue
            if (turn, role, text_hash) == seen:
                continue
            seen = (turn, role, text_hash)
            yield from inserted()
            edit, at = script[at], at + 1
            if edit == "K":
                yield conv_id, role, text
            elif edit in "ua":
                yield conv_id, "user" if edit == "u" else "assistant", text
    yield from inserted()
    if started:
        yield conv_id, None, None


def _ordered(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Texts that are not blank, and the scripts, by conversation and place."""
    place = ["conv_id", "turn", "role", "text_hash"]
    texts = _texts(rows).where(~_is_blank())
    scripts = edits.select(*place, F.lit(True).alias("is_script"), F.col("script").alias("text"))
    both = scripts.unionByName(texts.withColumn("is_script", F.lit(False)))
    return (
        both.repartition("conv_id")
        .sortWithinPartitions(*place, F.desc("is_script"))
        .select(*place, "is_script", "text")
    )


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield [c.to_pylist() for c in batch.slice(start, 256).columns]


def repaired_turns(rows: DataFrame, edits: DataFrame | None = None) -> DataFrame:
    """``conv_id``, ``place`` (from 0), ``role`` and ``text`` of the repaired conversations."""
    edits = _edits(written(_turns(rows), "symbols")) if edits is None else edits
    ordered = _ordered(rows, edits)
    schema = _by_conversation(rows, "place bigint, role string, text string")

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, found, kinds = 0, [], []

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch.schema.field("conv_id").type]
                yield batch

        def out() -> pa.RecordBatch:
            types = [*kinds, pa.int64(), pa.string(), pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
            found.clear()
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for conv_id, role, text in _replay(_lists(typed())):
            if role is None:
                place = 0
                continue
            found.append((conv_id, place, role, text))
            place += 1
            if len(found) >= 256:
                yield out()
        if found:
            yield out()

    return ordered.mapInArrow(replay, schema)


def _digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``conv_id`` and SHA-256 of its repaired rows as ``role:text`` lines."""
    ordered = _ordered(rows, edits)
    schema = _by_conversation(rows, "repaired_sha256 string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, ids, found = [], [], []

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds[:] = [batch.schema.field("conv_id").type]
                yield batch

        running, first = sha256(), True
        for conv_id, role, text in _replay(_lists(typed())):
            if role is None:
                ids.append(conv_id)
                found.append(running.hexdigest())
                running, first = sha256(), True
                continue
            running.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, *kinds), pa.array(found, pa.string())], names=schema.names
            )

    return ordered.mapInArrow(digest, schema)


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``).

    ``gaps`` in its turns, its ``blank``, ``duplicate`` and ``truncated`` rows, its ``illegal`` pairs
    of neighbouring roles, the ``cost`` and the initials (``audit``) of the edits that repair it, and
    the digest of the repaired rows, which :func:`repaired_turns` returns themselves.
    """
    turns = written(_turns(rows), "symbols")
    edits = _edits(turns)
    piece = F.struct("part", "piece", "audit")
    wide = ["gaps", "blank", "duplicate", "truncated"]
    parts = [
        _counts(turns),
        edits.select("conv_id", piece.alias("piece"), "cost", "illegal"),
        _digests(rows, edits),
    ]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part, allowMissingColumns=True)
    pieces = F.array_sort(F.collect_list("piece"))
    return everything.groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in (*wide, "illegal", "cost")),
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
        F.max("repaired_sha256").alias("repaired_sha256"),
    )


def damage(rows: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with one in twenty dropped, emptied, unpunctuated, repeated and
    given the role user each, chosen by a checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat_ws(
        ":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    )
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    bare = F.regexp_replace(text, "[.!?]", "")
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        rows.where(kind != 0)
        .select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "").when(kind == 2, bare).otherwise(text).alias("text"),
            F.explode(copies),
        )
        .drop("col")
    )
