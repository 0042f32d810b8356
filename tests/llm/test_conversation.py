"""Operator 13 against a plain search over (row, grammar state)."""

import hashlib
import random
import re
import zlib

from helpers import SF
from matchlake.llm import conversation as C

CONVERSATIONS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(key.encode()) % 20
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        inner = text.strip(" \t\n\r\x0b\x0c")
        out.append(C.BLANK if not inner else C.DUPLICATE if (role, text) in seen
                   else C.KEPT if inner[-1] in ".!?" else C.CUT)
        seen.add((role, text))
    return out


def cheapest(initials, faults):
    """Least (cost, audit) for every (row, grammar state), from the last row to the first."""
    n, after = len(initials), None
    for row in range(n, -1, -1):
        here = {q: (0, "") for q in C.ACCEPTING} if row == n else {}
        if row < n:
            for q in range(4):
                ways = [(2 + after[q][0], "D" + after[q][1])] if q in after else []
                if faults[row] in (C.KEPT, C.CUT):
                    extra = 5 if faults[row] == C.CUT else 0
                    for e, cost, c in [("K", 0, initials[row]), ("R", 1, "u"), ("R", 1, "a")]:
                        to = C.STEP.get((q, c))
                        if to in after:
                            ways.append((extra + cost + after[to][0], e + after[to][1]))
                if ways:
                    here[q] = min(ways)
        for _ in range(4):  # inserts in front of the row
            for q in range(4):
                for c in "ua":
                    to = C.STEP.get((q, c))
                    if to in here:
                        here[q] = min(here.get(q, (10**9, "")), (5 + here[to][0], "I" + here[to][1]))
        after = here
    return after[C.START]


def written(rows, audit):
    out, state, left = [], "", list(rows)
    want = lambda: "assistant" if state.endswith("u") else "user"
    for e in audit:
        role, text = (want(), "") if e == "I" else left.pop(0)[2:]
        if e != "D":
            role = want() if e == "R" else role
            out.append(f"{role}:{text}")
            state += role[:1]
    assert not left and GRAMMAR.fullmatch(state)
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(table):
    by_conv = {}
    for r in table:
        by_conv.setdefault(r[0], []).append(r)
    out = {}
    for conv, rows in by_conv.items():
        rows = sorted(damaged(rows), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(),
                                                    r[3].encode()))
        faults, initials = faults_of(rows), [r[2][:1] for r in rows]
        cost, audit = cheapest(initials, faults)
        turns = {r[1] for r in rows if r[1] is not None}
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                     faults.count(C.BLANK), faults.count(C.DUPLICATE), faults.count(C.CUT),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, written(rows, audit))
    return out


def found(df):
    rows = df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                     "audit", "repaired_sha256").collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_op13_whole_table_against_plain_search(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    assert found(C.query(spark, SF)) == expected(table)


def test_op13_search_equals_plain_search_on_random_conversations():
    rng = random.Random(5)
    for _ in range(3000):
        n = rng.randrange(12)
        initials = rng.choices(["s", "u", "a", "x", ""], [2, 5, 5, 1, 1], k=n)
        faults = rng.choices(range(4), [7, 1, 1, 2], k=n)
        assert C.repair(initials, faults) == cheapest(initials, faults)


def test_op13_long_conversations_are_near_linear():
    import time
    rng = random.Random(7)
    initials, faults = rng.choices("sua", k=20_000), rng.choices(range(4), [7, 1, 1, 2], k=20_000)
    begun = time.time()
    cost, audit = C.repair(initials, faults)
    assert time.time() - begun < 30 and cost == cheapest_cost(initials, faults)
    assert len(audit.replace("I", "")) == 20_000


def cheapest_cost(initials, faults):
    after = {C.START: 0, C.ASSISTANT: 0, C.USER: 5, C.SYSTEM: 10}
    for initial, fault in zip(reversed(initials), reversed(faults)):
        here = {q: 2 + after[q] for q in after}
        if fault in (C.KEPT, C.CUT):
            extra = 5 * (fault == C.CUT)
            for q in after:
                for c, cost in (("u", 1), ("a", 1), (initial, 0)):
                    to = C.STEP.get((q, c))
                    if to is not None:
                        here[q] = min(here[q], extra + cost + after[to])
        for _ in range(3):
            for (q, c), to in C.STEP.items():
                if c != "s":
                    here[q] = min(here[q], 5 + here[to])
        after = here
    return after[C.START]


def test_op13_odd_rows(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\t\n", "Yes.", "No", "Well? ", "a\nb!", "é…", "x" * 50_000, "…!\x85",
             "ok.\x0b\x0c"]
    rows = [(rng.choice([None, -4, 7, 8, 9]), rng.choice([None, -3, 0, 1, 2, 5, 5, 2**40]),
             rng.choice([None, "", "user", "assistant", "system", "tool"]), rng.choice(texts))
            for _ in range(150)]
    rows += rows[:20] + [(100 + i, i, "user", "Hi.") for i in range(60)]  # some lose all rows
    df = spark.createDataFrame(rows, CONVERSATIONS)
    for c in ("audit", "copy", "harm", "digest", "cost"):
        df = df.selectExpr("*", f"'x' AS {c}")
    got, want = found(C.repair_conversations(df.repartition(5))), expected(rows)
    assert got == want
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert none in got.values()


def test_op13_empty_table(spark):
    out = C.repair_conversations(spark.createDataFrame([], CONVERSATIONS))
    assert out.count() == 0 and "repaired_sha256" in out.columns
