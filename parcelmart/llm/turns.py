"""Repair of conversations: the cheapest edits after which the roles read ``(system? (user assistant)+)?``.

A row's first fault counts: blank (no visible character), duplicate (role and text stood earlier in the conversation),
truncated (the last visible character does not end a sentence). Rows are kept (0), given the role that is missing (2),
deleted (3, required for blank and duplicate rows), and empty rows are inserted (2); a truncated row that stays costs 1.
Among the cheapest repairs the one whose initials (D, I, K, R) are least in ASCII order is taken.

That is a shortest path through four states (start, after system, user, assistant), found by a Viterbi recursion that runs
backwards, in parallel by rank convergence. All rows are sorted by conversation and turn over range partitions, so that a
conversation may lie in many of them. Inside a partition chunks of rows run side by side, each from a speculative vector of
costs; fix-up passes rerun a chunk from its successor's vector until the new vectors differ from the old ones by a constant
only, which settles all rows before. Partitions are stitched in the same way, with one vector each at the driver. Then the
stitched costs say for every row and state which edit is least, chunks are traced from all four states at once, and the
traces are chained.

The last step is a stream: an SHA-256 over a conversation's lines can be taken in order only, so one task reads them one
after the other and keeps counters, the running hash and the audit, never the texts.

Defined results: null roles and texts are one blank, null turns come first, rows of equal turn are ordered by a hash of
role and text. Repeated rows are combined before they are sorted and counted as often as they occur. Rows with a null
conversation form a conversation. Roles count by their first character; a row with another one than s, u, a cannot be kept.
Other columns than ``conv_id, turn, role, text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.shared import written

#: Rows of a chunk.
CHUNK = 256
BLANKS = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
KINDS = "sua"
#: The state that a row of the missing role, or an inserted one, leads to.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: The state that a kept row leads to, by its kind (s, u, a, other) and the state before; -1: it cannot be kept.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
REROLE, DELETE, INSERT, NEVER = 2, 3, 2, 1 << 20
#: Signs of rows: kind, plus 4 if truncated, or FORCED for a row that must go.
FORCED = 8
ROLE = {"u": "user", "a": "assistant"}
#: Letters of rows inserted from a state on, and of those that end a conversation.
INSERTED = [["", "u", "ua"], ["", "u", "ua"], ["", "a", "au"], ["", "u", "ua"]]
ENDING = ["", "ua", "a", ""]
OPS = np.array(["D", "I", "K", "R"])


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs from each state when rows may be inserted first."""
    user = np.minimum(costs[..., USER], INSERT + costs[..., ASSISTANT])
    assistant = np.minimum(costs[..., ASSISTANT], INSERT + user)
    first, system = (np.minimum(costs[..., s], INSERT + user) for s in (START, SYSTEM))
    return np.stack([first, system, user, assistant], axis=-1)


END = _with_inserts(np.array([0, NEVER, NEVER, 0]))


def _row_costs(signs: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Costs from each state by deleting, keeping and reroling rows, given the costs ``after`` each."""
    forced, cut = signs == FORCED, (signs >= 4) & (signs != FORCED)
    to = KEPT[np.where(forced, 3, signs % 4)]
    extra = np.where(forced, NEVER, cut)[..., None]
    kept = np.where(to >= 0, np.take_along_axis(after, np.maximum(to, 0), -1) + extra, NEVER)
    return after + DELETE, np.minimum(kept, NEVER), np.minimum(after[..., NEXT] + REROLE + extra, NEVER)


def _level(costs: np.ndarray) -> np.ndarray:
    """Without what all states have in common: vectors that differ by a constant become equal."""
    return costs - costs.min(axis=-1, keepdims=True)


def costs_after(signs: np.ndarray, last: np.ndarray, end: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, int]:
    """Level costs after each row and before the first, and the number of passes. ``last``: the row ends its conversation."""
    lanes = max(1, -(-len(signs) // chunk))
    space = lanes * chunk - len(signs)
    signs = np.concatenate([signs, np.full(space, FORCED)]).reshape(lanes, chunk)
    last = np.concatenate([last, np.zeros(space, bool)]).reshape(lanes, chunk)
    after, begin = np.zeros((lanes, chunk, 4), np.int64), np.zeros((lanes, 4), np.int64)
    start = np.zeros((lanes, 4), np.int64)  # speculative
    start[-1] = _level(end)
    active, passes = np.arange(lanes), 0
    while len(active):
        lane, now = active, start[active]
        for c in range(chunk - 1, -1, -1):
            now = np.where(last[lane, c, None], END, now)
            if passes:
                open_lanes = (after[lane, c] != now).any(axis=1)
                lane, now = lane[open_lanes], now[open_lanes]
                if not len(lane):
                    break
            after[lane, c] = now
            now = _level(_with_inserts(np.minimum.reduce(_row_costs(signs[lane, c], now))))
        begin[lane] = now
        passes += 1
        active = np.flatnonzero((start[:-1] != begin[1:]).any(axis=1))
        start[active] = begin[active + 1]
    return after.reshape(-1, 4)[: lanes * chunk - space], begin[0], passes


def least_edits(signs: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row and state before it: inserted rows, the edit (index into ``OPS``), and the state that follows."""
    deleted, kept, reroled = _row_costs(signs, after)
    best = _with_inserts(np.minimum(np.minimum(deleted, kept), reroled))
    op = np.select([deleted == best, best[:, NEXT] + INSERT == best, kept == best], [0, 1, 2], 3)
    state, inserts = np.tile(np.arange(4), (len(signs), 1)), np.zeros((len(signs), 4), np.int64)
    for _ in range(2):
        more = np.take_along_axis(op, state, 1) == 1
        inserts += more
        state = np.where(more, NEXT[state], state)
    edit = np.take_along_axis(op, state, 1)
    to = np.take_along_axis(KEPT[np.where(signs == FORCED, 3, signs % 4)], state, 1)
    return inserts, edit, np.choose(edit, [state, state, to, NEXT[state]])


def states_before(to: np.ndarray, last: np.ndarray, first: int | None, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """The state before each row when the first row is met in ``first``, and the state after all rows for any first one."""
    lanes = max(1, -(-len(to) // chunk))
    to = np.where(last[:, None], START, to)
    to = np.concatenate([to, np.tile(np.arange(4), (lanes * chunk - len(to), 1))]).reshape(lanes, chunk, 4)
    lane, ends = np.arange(lanes), np.tile(np.arange(4), (lanes, 1))
    for c in range(chunk):
        ends = to[lane[:, None], c, ends]
    whole, starts = np.arange(4), np.zeros(lanes, np.int64)
    for k in range(lanes):
        starts[k] = whole[first or 0]
        whole = ends[k][whole]
    found = np.zeros((lanes, chunk), np.int64)
    for c in range(chunk):
        found[:, c] = starts
        starts = to[lane, c, starts]
    return found.reshape(-1), whole


def _signed(part: pa.Table, runs_on: bool) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A partition's rows in order, their signs, and which of them end a conversation."""
    part = part.sort_by("number")
    codes = pd.factorize(part.column("conv_id").to_pandas(), use_na_sentinel=False)[0]
    last = np.append(codes[1:] != codes[:-1], not runs_on)
    return part, part.column("sign").to_numpy().astype(np.int64), last


def _prepared(rows: DataFrame) -> DataFrame:
    """Distinct rows in order, written: ``number, conv_id, turn, role, text, n, blank, seen, cut``."""
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    mark = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("mark")
    single = rows.groupBy("conv_id", "turn", "role", "text", mark).agg(F.count(F.lit(1)).alias("n"))
    places = single.groupBy(F.col("conv_id").alias("_conv"), F.col("mark").alias("_mark")).agg(
        F.min("turn").alias("_turn"), F.max(F.col("turn").isNull()).alias("_unplaced")
    )
    joined = single.join(places, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("mark") == F.col("_mark")))
    shown = F.rtrim("text", F.lit(BLANKS))
    named = joined.select(
        "conv_id", "turn", "role", "text", "n", "mark", (shown == "").alias("blank"),
        (F.col("turn").isNotNull() & (F.col("_unplaced") | (F.col("turn") > F.col("_turn")))).alias("seen"),
        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    order = ["conv_id", "turn", "mark"]
    ranged = named.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.select(F.monotonically_increasing_id().alias("number"), "*").drop("mark"), "turns")


def _by_part(signs: DataFrame, parts: list[int] | None, work: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    chosen = signs if parts is None else signs.where(F.col("part").isin(parts))
    return chosen.groupBy("part").applyInArrow(lambda key, part: work(key[0].as_py(), part), schema)


def _edits(rows: DataFrame) -> DataFrame:
    """``number, before, op, to, behind`` of each row: letters of inserted rows, the edit, the new role's letter."""
    kind = F.lit(len(KINDS))
    for number, letter in enumerate(KINDS):
        kind = F.when(F.col("role").startswith(letter), number).otherwise(kind)
    sign = F.when(F.col("blank") | F.col("seen"), FORCED).otherwise(kind + F.when(F.col("cut"), 4).otherwise(0))
    part = F.shiftright("number", 33).cast("int").alias("part")
    signs = rows.select(part, "number", "conv_id", sign.cast("int").alias("sign"))
    # One row for each partition: which of them go on with the conversation of the one before.
    edges = signs.groupBy("part").agg(F.min_by("conv_id", "number").alias("first"), F.max_by("conv_id", "number").alias("last")).collect()
    edges = sorted(edges, key=lambda e: e["part"])
    order = [e["part"] for e in edges]
    follower = {a["part"]: b["part"] for a, b in zip(edges, edges[1:], strict=False) if a["last"] == b["first"]}

    asked = set(follower.values())
    single = {e["part"] for e in edges if e["first"] == e["last"]}  # elsewhere a conversation's end settles the vector

    ends = {p: [0, 0, 0, 0] if p in follower else END.tolist() for p in order}  # speculative where a conversation runs on
    begins: dict[int, list[int]] = {}
    todo = sorted(asked)
    while todo:

        def backward(p: int, table: pa.Table, ends: dict = ends) -> pa.Table:
            _, own, last = _signed(table, p in follower)
            return pa.table({"part": pa.array([p], pa.int32()), "begin": [costs_after(own, last, np.array(ends[p]))[1].tolist()]})

        begins |= {r["part"]: r["begin"] for r in _by_part(signs, todo, backward, "part int, begin array<long>").collect()}
        changed = {p: begins[q] for p, q in follower.items() if begins[q] != ends[p]}
        ends = ends | changed
        todo = sorted(asked & single & changed.keys())

    def traced(p: int, table: pa.Table) -> tuple:
        table, own, last = _signed(table, p in follower)
        return table, own, last, least_edits(own, costs_after(own, last, np.array(ends[p]))[0])

    def whole(p: int, table: pa.Table) -> pa.Table:
        _, _, last, (_, _, to) = traced(p, table)
        return pa.table({"part": pa.array([p], pa.int32()), "to": [states_before(to, last, None)[1].tolist()]})

    into = {r["part"]: r["to"] for r in _by_part(signs, sorted(follower), whole, "part int, to array<long>").collect()} if follower else {}
    firsts, state = {}, START
    for p in order:
        firsts[p] = state
        state = into[p][state] if p in follower else START

    def trace(p: int, table: pa.Table) -> pa.Table:
        table, _, last, (inserts, edit, to) = traced(p, table)
        state, every = states_before(to, last, firsts[p])[0][: len(last)], np.arange(len(last))
        inserts, edit, to = (x[every, state] for x in (inserts, edit, to))
        before = [INSERTED[s][k] for s, k in zip(state.tolist(), inserts.tolist(), strict=True)]
        behind = [ENDING[t] if end else "" for t, end in zip(to.tolist(), last.tolist(), strict=True)]
        letters = np.array(list("-sua"))[to]
        columns = {"number": table.column("number"), "before": before, "op": OPS[edit].tolist(), "to": letters.tolist(), "behind": behind}
        return pa.table(columns)

    return _by_part(signs, None, trace, "number long, before string, op string, to string, behind string")


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = {"su", "ua", "au"}


class _Reader:
    """Counters, running hash and audit of the conversation that is read."""

    def __init__(self) -> None:
        self.count = dict.fromkeys(_COUNTS, 0)
        self.turns, self.low, self.high, self.initial = 0, None, None, None
        self.audit: list[str] = []
        self.digest, self.lines = hashlib.sha256(), 0

    def line(self, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def insert(self, letters: str) -> None:
        for letter in letters:
            self.line(f"{ROLE[letter]}:")
            self.audit.append("I")
            self.count["cost"] += INSERT

    def row(self, turn, role, text, n, blank, seen, cut, before, op, to, behind) -> None:
        count = self.count
        if turn is not None and turn != self.high:
            self.turns, self.high, self.low = self.turns + 1, turn, turn if self.low is None else self.low
        if self.initial is not None:
            count["illegal"] += self.initial + role[:1] not in _LEGAL
        count["illegal"] += n - 1
        self.initial = role[:1]
        if blank or seen:
            count["blank" if blank else "duplicate"] += n
        else:
            count["truncated"] += cut
            count["duplicate"] += n - 1
        self.insert(before)
        if op == "D":
            deleted = n
        else:
            deleted = n - 1
            self.line(f"{ROLE[to] if op == 'R' else role}:{text}")
            self.audit.append(op)
            count["cost"] += (REROLE if op == "R" else 0) + cut
        self.audit.append("D" * deleted)
        count["cost"] += DELETE * deleted
        self.insert(behind)

    def result(self) -> list:
        if self.turns:
            self.count["gaps"] = self.high - self.low + 1 - self.turns
        return [*self.count.values(), "".join(self.audit), self.digest.hexdigest()]


def _read(rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, conv, done, kind_of = None, None, [], None

        def batch_of(done: list) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            types = [kind_of, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            kind_of = batch.schema.field("conv_id").type
            for own, *values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if reader is None or own != conv:
                    if reader is not None:
                        done.append([conv, *reader.result()])
                    reader, conv = _Reader(), own
                reader.row(*values)
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        if reader is not None:
            yield batch_of([*done, [conv, *reader.result()]])

    columns = ["conv_id", "turn", "role", "text", "n", "blank", "seen", "cut", "before", "op", "to", "behind"]
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "number").select(*columns)
    return ordered.mapInArrow(read, schema)


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``every``: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``
    of its rows in ``rows``. Without rows: zeros, an empty audit and the hash of the empty string.
    """
    own = _prepared(rows)
    found = _read(own.join(_edits(own), "number")).withColumnRenamed("conv_id", "_conv")
    ids = every.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _COUNTS]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select("conv_id", *counts, *texts)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by a checksum of conversation and turn: dropped, emptied, without sentence ends, repeated,
    or said by the user; most stay as they are.
    """
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    draw = F.crc32(F.concat_ws(":", *parts).cast("binary")) % 20

    def case(value: int, then: Column, otherwise: Column) -> Column:
        return F.when(draw == value, then).otherwise(otherwise)

    text = case(1, F.lit(""), case(2, F.translate("text", ".!?", ""), F.col("text")))
    copies = case(0, F.lit(0), case(3, F.lit(2), F.lit(1)))
    changed = rows.select("conv_id", "turn", case(4, F.lit("user"), F.col("role")).alias("role"), text.alias("text"), copies.alias("copies"))
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).drop("copy")
