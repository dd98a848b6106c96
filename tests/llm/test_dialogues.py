"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rowgate.llm import dialogues

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = [" " if v is None else v for v in (role, text)]
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) by the table of all suffixes: state -> least (cost, edits), built from the end."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ()), "a": (0, "", ())}

    def insertions(best):
        for state in ("u", "s", "u", "", "a", "u", "s", ""):
            if after[state] in best:
                cost, audit, lines = best[after[state]]
                new = (cost + 3, "I" + audit, (f"{name[after[state]]}:", *lines))
                best[state] = min(best.get(state, new), new, key=lambda b: b[:2])

    insertions(best)
    for role, text, fault in reversed(rows):
        now = {}
        for state in ("", "s", "u", "a"):
            offers = []
            if state in best:
                cost, audit, lines = best[state]
                offers.append((cost + 4, "D" + audit, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                to = after[state]
                if to in best:
                    cost, audit, lines = best[to]
                    offers.append((cost + 3 + more, "R" + audit, (f"{name[to]}:{text}", *lines)))
                first = role[:1]
                if (first == "s" and state == "" or first == after[state]) and first in best:
                    cost, audit, lines = best[first]
                    offers.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
            if offers:
                now[state] = min(offers, key=lambda b: b[:2])
        best = now
        insertions(best)
    return best[""]


def expected(rows, damage=True):
    convs = {}
    for row in rows:
        convs.setdefault(row[0], [])
    for row in damaged(rows) if damage else [(c, t, *(" " if v is None else v for v in r)) for c, t, *r in rows]:
        convs[row[0]].append(row[1:])
    out = []
    for conv, said in convs.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in said:
            body = text.strip(WHITE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for t, _, _ in said if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = cheapest(judged)
        counts = [sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(seed, n, convs, turns):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher", "Ä"]
    texts = ["Yes.", "No", "Why? ", "  ", "", None, "Ü!\n", "a ", "x.", "long " * 5 + "."]
    return [
        (pick.choice([*range(convs), None]), pick.choice([*range(turns), None]), pick.choice(roles), pick.choice(texts) if pick.random() < 0.6 else f"t{pick.random()}.")
        for _ in range(n)
    ]


@pytest.fixture
def spread(spark):
    """Ranges are not merged, so that conversations lie across them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.mark.parametrize("seed", range(200))
def test_recursion_finds_least_edits(seed):
    pick = random.Random(seed)
    codes = bytes(pick.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 2, 3]) for _ in range(pick.randrange(14)))
    faults = ["", "truncated"]
    rows = [
        ("x", "", "blank") if c == 0 else (["system", "user", "assistant", "x"][(c - 1) % 4], str(i), faults[c > 4])
        for i, c in enumerate(codes)
    ]
    states, audit, cost = dialogues.solve(codes, dialogues.EMPTY, dialogues.END)
    kept = [r for r, c in zip(rows, codes) if c]
    said = dialogues.lines(codes, states, [r[0] for r in kept], [r[1] for r in kept])
    said += dialogues.tail_lines(states[-1])
    assert (cost, audit + dialogues.TAIL[states[-1]], tuple(said)) == cheapest(rows)


@pytest.mark.parametrize("rows", [dict(n=400, convs=60, turns=6), dict(n=300, convs=2, turns=50)])
def test_query_equals_plain_search(spark, spread, rows):
    made = random_rows(7, **rows)
    df = spark.createDataFrame(made, SCHEMA).withColumns({"conv": F.lit("x"), "_digest": F.lit(1), "part": F.lit(2)})
    hurt = dialogues.damage(df)
    got = dialogues.repair(hurt, copies=F.col("copies"), block_rows=5, block_bytes=100)
    assert sorted(map(tuple, got.collect()), key=str) == expected(made)


def test_repeated_rows_are_counted_not_gathered(spark, spread):
    rows = [(1, 0, "user", "Hi.")] * 3000 + [(1, 1, "assistant", "Ho.")] * 40 + [(2, 0, "user", "Hi.")]
    got = dialogues.repair(spark.createDataFrame(rows, SCHEMA), block_rows=64)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, damage=False)


def test_edge_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dialogues.repair(empty).collect() == []
    rows = [(5, None, None, None), (None, 3, "user", "x" * 200_000 + "."), (6, -(2**63), "user", "a."), (6, 2**63 - 1, "assistant", "b.")]
    got = {r.conv_id: r for r in dialogues.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[5].blank, got[5].audit, got[5].repaired_sha256) == (1, "D", hashlib.sha256(b"").hexdigest())
    assert got[None].audit == "KI"
    assert got[6].gaps == 2**63 - 1
