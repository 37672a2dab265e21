"""Repair of conversation structure by a dynamic programme over turns.

Roles must read ``(s?(ua)+)?`` by their initials (system, user, assistant).  Rows are
kept (cost 0), given another role (2), deleted (3) or inserted with an empty text (2);
blank rows and repeats are deleted, a truncated row that stays costs 1.

Every conversation has four states: nothing yet, after system, after user, after
assistant.  Conversations are bucketed by length and laid out time-major; the costs
from each turn to the end are updated for all conversations of a bucket at once, last
turn first, and kept; then edits are traced from the first turn on, for all at once,
taking of the cheapest edits the one whose letter comes first (D, I, K, R).

Rows are dealt out by ranges of (conversation, turn), so that a very long
conversation is many blocks in many tasks.  A block whose conversation ends inside
its task is settled there.  For the others costs are a matrix (from the state before
the block to the state after it); matrices are combined, which tells what the rest
of the conversation costs after each block; each block is then traced from every
state, and the traces are put together in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType

from .frames import importable, stage_table

#: Rows of a block; conversations have one or a few, as a rule.
BLOCK = 4096
#: White space, and the characters that end a complete text.
SPACE, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: What edits cost.
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1

_NONE, _S, _U, _A = range(4)
_FAR = 1 << 40
_GOES = np.array([_U, _U, _A, _U])  # where an inserted row, or one given another role, leads from each state
_KEPT = {0: {_NONE: _S}, 1: {_NONE: _U, _S: _U, _A: _U}, 2: {_U: _A}, 3: {}}  # by initial: s, u, a, others
#: Codes of rows: 3 * initial + (0 sound, 1 truncated, 2 to be deleted); then one that fills a bucket.
PAD = 12
_keep_cost, _keep_goes = np.full((13, 4), _FAR), np.zeros((13, 4), np.int64)
_rerole_cost, _delete_cost = np.full(13, _FAR), np.full(13, DELETE)
_delete_cost[PAD] = 0
for _role, _steps in _KEPT.items():
    for _fault in (0, 1):
        _rerole_cost[3 * _role + _fault] = REROLE + _fault * TRUNCATED
        for _from, _to in _steps.items():
            _keep_cost[3 * _role + _fault, _from], _keep_goes[3 * _role + _fault, _from] = _fault * TRUNCATED, _to


def _closed(costs: np.ndarray) -> np.ndarray:
    """Costs from each state (axis 1) when rows may be inserted first."""
    for _ in range(3):
        costs = np.minimum(costs, INSERT + costs[:, _GOES])
    return costs


END = _closed(np.array([[0, _FAR, _FAR, 0]]))[0]
_EACH = _closed(np.where(np.eye(4, dtype=bool), 0, _FAR)[None])[0]


def backward(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """(turns + 1, conversations, 4, ...): the cost from each turn and state on, for what lies ``after`` (conversations, 4, ...)."""
    costs = np.empty((len(codes) + 1, *after.shape), np.int64)
    costs[-1] = _closed(after)
    ones = (1,) * (after.ndim - 2)
    each = np.arange(codes.shape[1])[:, None]
    for t in range(len(codes) - 1, -1, -1):
        code, later = codes[t], costs[t + 1]
        keep = later[each, _keep_goes[code]] + _keep_cost[code].reshape(-1, 4, *ones)
        rerole = later[:, _GOES] + _rerole_cost[code].reshape(-1, 1, *ones)
        costs[t] = _closed(np.minimum(np.minimum(keep, rerole), later + _delete_cost[code].reshape(-1, 1, *ones)))
    return costs


def trace(codes: np.ndarray, costs: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[list[list[str]], np.ndarray]:
    """Edits of each conversation from each state of ``state`` (conversations, k), and the states they lead to.

    Of the cheapest edits the one with the least letter is taken, turn by turn;
    where ``last``, rows are inserted at the end until it is complete.
    """
    n, k = state.shape
    each = np.arange(n)[:, None]
    letters = []
    for t, code in enumerate(codes):
        code, here, later = code[:, None], costs[t], costs[t + 1]
        left = np.broadcast_to(code != PAD, (n, k)).copy()
        while left.any():
            now = here[each, state]
            delete = left & (now == _delete_cost[code] + later[each, state])
            insert = left & ~delete & (now == INSERT + here[each, _GOES[state]])
            keeps = _keep_goes[code, state]
            keep = left & ~delete & ~insert & (now == _keep_cost[code, state] + later[each, keeps])
            rerole = left & ~delete & ~insert & ~keep
            letters.append(np.select([delete, insert, keep, rerole], [ord("D"), ord("I"), ord("K"), ord("R")], 0).astype(np.uint8))
            state = np.where(insert | rerole, _GOES[state], np.where(keep, keeps, state))
            left = insert
    for _ in range(2):
        insert = last[:, None] & ((state == _S) | (state == _U))
        letters.append(np.where(insert, ord("I"), 0).astype(np.uint8))
        state = np.where(insert, _GOES[state], state)
    by_row = np.ascontiguousarray(np.stack(letters).transpose(1, 2, 0))
    return [[one.tobytes().replace(b"\0", b"").decode() for one in row] for row in by_row], state


def buckets(lengths: np.ndarray, cells: int = 200_000) -> Iterator[np.ndarray]:
    """Indices of conversations by like length (within a power of two), so many that a bucket is about ``cells`` large at most."""
    by = np.argsort(lengths, kind="stable")
    first = 0
    while first < len(by):
        room = max(1, 2 * int(lengths[by[first]]))
        last = min(int(np.searchsorted(lengths[by], room, side="right")), first + max(1, cells // room))
        yield by[first : max(last, first + 1)]
        first = max(last, first + 1)


def time_major(codes: list[np.ndarray], some: np.ndarray) -> np.ndarray:
    """(turns, conversations) codes of a bucket, filled up with PAD."""
    out = np.full((max((len(codes[i]) for i in some), default=0), len(some)), PAD, np.int64)
    for column, i in enumerate(some):
        out[: len(codes[i]), column] = codes[i]
    return out


def apply(edits: str, rows: list[tuple[str, str, int, int]], state: int) -> tuple[str, list[dict], int]:
    """(edits of all rows, repaired messages, cost) of a block of (role, text, code, copies), entered in ``state``."""
    said, out, cost, at = [], [], 0, 0
    for edit in edits:
        said.append(edit)
        own = "assistant" if state == _U else "user"
        if edit == "I":
            out.append({"role": own, "text": ""})
            state, cost = int(_GOES[state]), cost + INSERT
            continue
        role, text, code, copies = rows[at]
        at += 1
        if edit == "D":
            cost += DELETE
        else:
            out.append({"role": role if edit == "K" else own, "text": text})
            cost += int(_keep_cost[code, state] if edit == "K" else _rerole_cost[code])
            state = int(_keep_goes[code, state] if edit == "K" else _GOES[state])
        said.append("D" * (copies - 1))  # the repeats of a row follow it
        cost += DELETE * (copies - 1)
    return "".join(said), out, cost


# -- Spark ----------------------------------------------------------------------------

_MESSAGES = "array<struct<role: string, text: string>>"
_COUNTS = ("first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal")
_BLOCK = f"part long, whole boolean, edits string, messages {_MESSAGES}, {' long, '.join(_COUNTS)} long, cost long"
_OPEN = f"{_BLOCK}, codes array<int>, copies array<long>, costs array<long>"
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _numbers(rows: list[tuple]) -> dict[str, int | None]:
    """What is counted of the rows (turn, role, text, code, copies, repeat) of a block."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[3] // 3 for r in rows]
    return {
        "first_turn": min(turns, default=None), "last_turn": max(turns, default=None), "turns": len(set(turns)),
        "blank": sum(r[4] for r in rows if r[5] is None),
        "duplicate": sum(r[4] - 1 + r[5] for r in rows if r[5] is not None),
        "truncated": sum(r[3] % 3 == 1 for r in rows),
        "illegal": sum(r[4] - 1 for r in rows) + sum((a, b) not in _LEGAL for a, b in zip(initials, initials[1:])),
    }


def _plain(rows: list[tuple]) -> list[tuple[str, str, int, int]]:
    return [(r[1], r[2], r[3], r[4]) for r in rows]


def _blocks(id_type: pa.DataType, schema: pa.Schema, block: int, rows_at_once: int = 50_000):
    """From sorted rows to blocks: settled ones, and open ones with their rows and cost matrices."""

    def settled(held: list[tuple]) -> pa.RecordBatch:
        codes = [np.array([r[3] for r in rows], np.int64) for _, _, _, rows in held]
        out = [None] * len(held)
        for some in buckets(np.array([len(c) for c in codes])):
            laid = time_major(codes, some)
            whole = np.array([held[i][2] for i in some])
            if whole.any():
                some_laid = laid[:, whole]
                costs = backward(some_laid, np.broadcast_to(END, (some_laid.shape[1], 4)))
                edits, _ = trace(some_laid, costs, np.zeros((some_laid.shape[1], 1), np.int64), np.ones(some_laid.shape[1], bool))
                for i, (one,) in zip(some[whole], edits):
                    conv, part, _, rows = held[i]
                    said, messages, cost = apply(one, _plain(rows), _NONE)
                    out[i] = {"conv_id": conv, "part": part, "whole": True, "edits": said, "messages": messages, "cost": cost, **_numbers(rows)}
            if not whole.all():
                matrices = backward(laid[:, ~whole], np.broadcast_to(_EACH, (int((~whole).sum()), 4, 4)))[0]
                for i, matrix in zip(some[~whole], matrices):
                    conv, part, _, rows = held[i]
                    messages = [{"role": r[1], "text": r[2]} for r in rows]
                    out[i] = {"conv_id": conv, "part": part, "whole": False, "messages": messages, "codes": codes[i].tolist(), "copies": [r[4] for r in rows], "costs": matrix.ravel().tolist(), **_numbers(rows)}
        return pa.RecordBatch.from_pylist(out, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 33
        held, size, runs, now, rows, marked = [], 0, 0, None, [], None
        cut = False  # the conversation at hand has blocks already
        for batch in batches:
            for conv, turn, role, text, digest, code, blank, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if runs == 0 or conv != now:
                    if runs:
                        held.append((now, part, runs > 1 and not cut, rows))  # the first may have begun in another task
                        part, size = part + 1, size + len(rows)
                    now, rows, cut, runs, marked = conv, [], False, runs + 1, None
                if code is None:  # says that the row that follows has been said before
                    marked = (turn, role, digest)
                    continue
                if len(rows) >= block:
                    held.append((now, part, False, rows))
                    part, size, rows, cut = part + 1, size + len(rows), [], True
                if size >= rows_at_once:
                    yield settled(held)
                    held, size = [], 0
                repeat = marked == (turn, role, digest)
                rows.append((turn, role, text, code // 3 * 3 + 2 if repeat else code, copies, None if blank else int(repeat)))
        if runs:
            held.append((now, part, False, rows))  # it may go on in another task
        if held:
            yield settled(held)

    return run


def _chained(schema: pa.Schema):
    """From (conv_id, part, costs, ...) in order: the costs of what lies after each block, and whether nothing does.

    Holds 16 numbers for each block of a conversation.
    """

    def of(rows: list[dict]) -> Iterator[dict]:
        after = END
        out = []
        for row in reversed(rows):
            out.append({"conv_id": row["conv_id"], "part": row["part"], "after": after.tolist(), "last": not out})
            after = (np.array(row["costs"]).reshape(4, 4) + after).min(axis=1)
        return reversed(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, own in groupby(rows, lambda r: r["conv_id"]):
            out = list(of(list(own)))
            for i in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_pylist(out[i : i + 10_000], schema)

    return run


def _traced(names: list[str]):
    """Adds to open blocks what edits each state before them leads to: (edits, state after) for each of the four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.array(c, np.int64) for c in batch.column("codes").to_pylist()]
            after, last = np.array(batch.column("after").to_pylist()).reshape(-1, 4), np.array(batch.column("last").to_pylist(), bool)
            edits, states = [None] * len(codes), [None] * len(codes)
            for some in buckets(np.array([len(c) for c in codes], np.int64)):
                laid = time_major(codes, some)
                every = np.broadcast_to(np.arange(4), (len(some), 4))
                got, state = trace(laid, backward(laid, after[some]), every, last[some])
                for i, one, to in zip(some, got, state.tolist()):
                    edits[i], states[i] = one, to
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int64()))], names)

    return run


def _assembled(schema: pa.Schema):
    """Open blocks in order, with their edits applied from the state that the block before leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                rows = [(m["role"], m["text"], c, n) for m, c, n in zip(row["messages"], row["codes"], row["copies"])]
                state, initial, turn = _NONE, None, None
                if before is not None and before["conv_id"] == row["conv_id"]:
                    state, initial, turn = before["state"], before["initial"], before["turn"]
                said, messages, cost = apply(row["traces"][state], rows, state)
                if initial is not None:
                    row["illegal"] += (initial, rows[0][2] // 3) not in _LEGAL
                if turn is not None and row["first_turn"] == turn:
                    row["turns"] -= 1  # counted in the block before
                out.append({**row, "edits": said, "messages": messages, "cost": cost})
                before = {"conv_id": row["conv_id"], "state": row["states"][state], "initial": rows[-1][2] // 3, "turn": turn if row["last_turn"] is None else row["last_turn"]}
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _arrow(id_type: pa.DataType, ddl: str) -> pa.Schema:
    return pa.schema([pa.field("conv_id", id_type), *to_arrow_schema(StructType.fromDDL(ddl))])


def _code(role: Column, text: Column) -> Column:
    initial = F.left(role, F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    end = F.right(F.rtrim(text, F.lit(SPACE)), F.lit(1))
    return (3 * place + F.when(end == "", 2).when(end.isin(*ENDS), 0).otherwise(1)).cast("int")


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Blocks of repaired conversations: conv_id, part (their order), edits, messages, counts and cost.

    ``edits`` has a letter for each row in order and each inserted one (Delete,
    Insert, Keep, Rerole); ``messages`` are the repaired (role, text).  A
    conversation of up to ``block`` rows is one block as a rule (``whole``), and may
    be two where it lies at the edge of a task.  Rows come by turn, those without a
    turn first; rows of one turn by role, then by the SHA-256 of their text.  A null role or
    text is one space.  Rows without a conversation are one conversation (null).
    Rows that are equal in all four columns are repeats of each other.  An empty
    table gives an empty result; further columns are not looked at.
    """
    importable(conversations.sparkSession)
    id_type = conversations.schema[conv_col].dataType
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    # equal rows are counted before they are dealt out: they may be very many
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    code = _code(F.col("role"), F.col("text"))
    counted = counted.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("digest"), code.alias("code"), (code % 3 == 2).alias("blank"), "copies")
    # what was said in an earlier turn: told by digests, and marked by a row that sorts before the one it is about
    said = rows.where(code % 3 != 2).select("conv_id", "turn", "role", F.sha2("text", 256).alias("digest"))
    turn = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    again = said.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"), F.max(turn).alias("final"))
    again = again.where(~F.col("first").eqNullSafe(F.col("final"))).select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    later = said.join(again.hint("merge"), same).where(~turn.eqNullSafe(F.col("first"))).select("conv_id", "turn", "role", "digest").distinct()
    empty = {"text": "string", "code": "int", "blank": "boolean", "copies": "long"}
    marks = stage_table(later, "said").select(*(F.lit(None).cast(empty[c]).alias(c) if c in empty else c for c in counted.columns))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    dealt = counted.unionByName(marks).repartitionByRange(*order).sortWithinPartitions(*order, F.asc_nulls_first("code"))
    arrow_id, ddl = to_arrow_type(id_type), f"conv_id {id_type.simpleString()}, "
    blocks = stage_table(dealt.mapInArrow(_blocks(arrow_id, _arrow(arrow_id, _OPEN), block), ddl + _OPEN), "blocks")
    columns = ["conv_id", *(f.strip().split(" ")[0] for f in ("part", "whole", "edits", "messages", *_COUNTS, "cost"))]
    left = blocks.where("not whole")
    chain = left.select("conv_id", "part", "costs").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    chain = stage_table(chain.mapInArrow(_chained(_arrow(arrow_id, "part long, after array<long>, last boolean")), ddl + "part long, after array<long>, last boolean"), "chain")
    with_after = left.join(chain.select("part", "after", "last").hint("merge"), "part").select(*left.columns, "after", "last")
    more = "after array<long>, last boolean, traces array<string>, states array<long>"
    traced = with_after.mapInArrow(_traced([*with_after.columns, "traces", "states"]), ddl + f"{_OPEN}, {more}")
    traced = traced.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    done = traced.mapInArrow(_assembled(_arrow(arrow_id, _BLOCK)), ddl + _BLOCK)
    return blocks.where("whole").select(*columns).unionByName(done.select(*columns))


def _digested(schema: pa.Schema):
    """From blocks in order: a row for each conversation, with a running hash over its repaired messages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for conv, own in groupby(rows, lambda r: r["conv_id"]):
            total = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
            turns, audit, digest, begun = [], [], hashlib.sha256(), False
            for row in own:
                for name in total:
                    total[name] += row[name]
                turns += [t for t in (row["first_turn"], row["last_turn"]) if t is not None]
                turns = [min(turns), max(turns)] if turns else []
                audit.append(row["edits"])
                for m in row["messages"]:
                    digest.update(("\n" if begun else "").encode() + f"{m['role']}:{m['text']}".encode())
                    begun = True
            gaps = turns[1] - turns[0] + 1 - total.pop("turns") if turns else 0
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "gaps": gaps, **total, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}], schema)

    return run


def summarize_repairs(blocks: DataFrame) -> DataFrame:
    """A row for each conversation of ``repair_conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The hash is over ``role:text`` of the repaired messages, one a line.  A
    conversation in several blocks is read block by block in order, as a hash over
    the whole can only be; of it no more than a block and its edits are held.
    """
    importable(blocks.sparkSession)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    line = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    names = ["conv_id", *counts, "audit", "repaired_sha256"]
    whole = blocks.where("whole").select("conv_id", gaps, *counts[1:], F.col("edits").alias("audit"), F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))
    id_type = blocks.schema["conv_id"].dataType
    ddl = f"{' long, '.join(counts)} long, audit string, repaired_sha256 string"
    rest = blocks.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    rest = rest.mapInArrow(_digested(_arrow(to_arrow_type(id_type), ddl)), f"conv_id {id_type.simpleString()}, {ddl}")
    return whole.select(*names).unionByName(rest.select(*names))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage that the checksum of ``conv_id:turn`` decides: dropped, emptied, cut, repeated, another role.

    Fixed values: of 20 remainders 0 drops a row, 1 empties its text, 2 takes out
    its ``.!?``, 3 repeats it, 4 makes it the user's.  Nulls count as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("nth")).drop("nth")


def audit_conversations(conversations: DataFrame) -> DataFrame:
    """Damage, repair and summary: a row for each conversation of the table, also of those that lose all rows (zeros)."""
    found = summarize_repairs(repair_conversations(damage(conversations))).withColumnRenamed("conv_id", "c")
    ids = conversations.select("conv_id").distinct()
    out = ids.join(found.hint("merge"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return out.select("conv_id", *(F.coalesce(c, nothing.get(c, F.lit(0).cast("long"))).alias(c) for c in found.columns if c != "c"))
