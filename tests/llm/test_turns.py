import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest

from parcelmart.llm import turns
from parcelmart.llm.turns import END, costs_after, damaged, least_edits, repair, states_before

SCHEMA = "conv_id long, turn long, role string, text string"
VISIBLE = " \t\n\x0b\x0c\r"


def best_repair(rows):
    """Cheapest edits, ASCII-least, by search over (cost, audit). rows: (role, text, must go, truncated)."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in seen:
            continue
        seen.add((i, state))
        need = "assistant" if state == "u" else "user"
        heapq.heappush(queue, (cost + 2, audit + "I", i, need[0], (*lines, f"{need}:")))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, lines))
            if not gone:
                heapq.heappush(queue, (cost + 2 + cut, audit + "R", i + 1, need[0], (*lines, f"{need}:{text}")))
                if role[:1] == need[0] or role[:1] == "s" and state == "":
                    heapq.heappush(queue, (cost + cut, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))


def brute(rows):
    result = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, faulty, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in own:
            shown = text.rstrip(VISIBLE)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            if fault:
                counts[fault] += 1
            faulty.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
            seen.add((role, text))
        held = [t for t, _, _ in own if t is not None]
        gaps = max(held) - min(held) + 1 - len(set(held)) if held else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = best_repair(faulty)
        result[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return result


def got(frame):
    return {r[0]: tuple(r)[1:] for r in frame.select("conv_id", *turns._COUNTS, "audit", "repaired_sha256").collect()}


def dialogue(seed, conversations, longest=9):
    draw = random.Random(seed)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None], ["Yes.", "No", "Why?", " ", "", None, "a\nb!", "x. \t", "Ω"]
    return [
        (c, draw.choice([t, t, t, None, 3]), draw.choice(roles), draw.choice(texts))
        for c in range(conversations)
        for t in range(draw.randrange(longest))
    ]


def test_equals_search_over_edits(spark):
    rows = dialogue(1, 150) + [(None, 1, "user", "Hi."), (None, 2, "user", "Hi.")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS number", "3 AS mark").repartition(4)
    assert got(repair(frame, frame)) == brute(rows)


@pytest.mark.parametrize("chunk", [1, 2, 7])
def test_chunks_converge_to_the_whole(chunk):
    draw = np.random.default_rng(chunk)
    for size in (1, 2, 13, 60):
        signs, last = draw.integers(0, 9, size), draw.random(size) < 0.1
        last[-1] = True
        after, begin, _ = costs_after(signs, last, END, chunk)
        whole, first, passes = costs_after(signs, last, END, 1000)
        assert (after == whole).all() and (begin == first).all() and passes == 1
        to = least_edits(signs, after)[2]
        state, path = 0, []
        for row, end in zip(to, last, strict=True):
            path.append(state)
            state = 0 if end else row[state]
        assert states_before(to, last, 0, chunk)[0][:size].tolist() == path


def test_vectors_that_differ_by_a_constant_end_a_pass():
    signs = np.tile([1, 2], 5000)
    assert costs_after(signs, np.append(np.zeros(9999, bool), True), END, 100)[2] <= 3


def test_one_conversation_over_many_partitions(spark):
    draw = random.Random(3)
    rows = [(7, t, draw.choice(["user", "assistant", "system"]), draw.choice(["Yes.", "No", f"{t}."])) for t in range(400)]
    rows += [(7, 500, "user", "again.")] * 50 + [(3, 0, "user", "One."), (9, 0, "assistant", "Two.")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(repair(frame, frame)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_damage_and_conversations_without_rows(spark):
    rows = [(c, t, r, x) for c, t, r, x in [(c, t, ["user", "assistant"][t % 2], f"Say {t}. Or?") for c in range(60) for t in range(6)]]
    rows += [(900, None, None, None), (None, None, "user", "x.")]
    changed = []
    for c, t, r, x in rows:
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        r, x, draw = r or " ", x or " ", zlib.crc32(key.encode()) % 20
        x = "" if draw == 1 else x.translate(str.maketrans("", "", ".!?")) if draw == 2 else x
        changed += [(c, t, "user" if draw == 4 else r, x)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    frame = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in damaged(frame).collect()), key=key) == sorted(changed, key=key)
    gone = [c for c in range(60) if not any(r[0] == c for r in changed)]
    ids = spark.createDataFrame([(c,) for c in [*range(60), 900, None, 5000]], "conv_id long")
    none = (0,) * 6 + ("", hashlib.sha256().hexdigest())
    assert got(repair(damaged(frame), ids)) == brute(changed) | dict.fromkeys([*gone, 5000], none)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair(empty, empty).collect() == []
