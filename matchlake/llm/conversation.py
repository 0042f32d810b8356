"""Conversation structure repair by iterative-deepening A*.

Rows of a conversation, in order of turn, are edited at least cost until the
role initials read ``(s?(ua)+)?``: Keep (0), Rerole to the role that fits (1),
Delete (2; a must for blank and duplicate rows), Insert an empty turn (5), and 5
more for a truncated row that stays.

The search is a depth-first one under a cost bound.  At every row the edits are
tried in ASCII order of their initials (D, I, K, R), so the first accepting path
under the least bound is the ASCII-least of the cheapest ones.  A bound that
fails is raised to the least estimate that exceeded it.  Two things keep this
near linear in the length of a conversation:

* the estimate of what is left is a pattern database: the exact cost of the
  problem in which the states after a system turn and after an assistant turn are
  merged into "a user turn comes next, or nothing".  One sweep fills it.  It never
  exceeds the true cost and falls short of it only where all that is left after a
  system turn could be deleted;
* a failed-state table remembers for (row, grammar state) the largest budget that
  was of no use.

Rows are sorted by Spark and stream through the tasks twice: the first stream
keeps for the conversation at hand one digest and two codes a row (never its
texts) and finds the edits, the second carries out the edits on the rows and
feeds the hash.  A conversation has one audit and one hash, so one task reads it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import arrow_schema, read_table, save

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
KEPT, BLANK, DUPLICATE, CUT = range(4)
# Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
        (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = ("u", "u", "a", "u")  # the turn that a Rerole or Insert makes in a state
LEGAL = {"su", "ua", "au"}
NEVER = 1 << 60
BLANKS = "\\x20\\x09-\\x0D"


def _estimates(initials: list[str], faults: list[int]) -> list[tuple[int, int, int, int]]:
    """Least cost from each row to the end by grammar state, SYSTEM and ASSISTANT merged."""
    fresh, user, assistant = 0, 0, INSERT  # nothing yet; a user or an assistant turn comes next
    out = [(fresh, user, assistant, user)]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        here_f, here_u, here_a = DELETE + fresh, DELETE + user, DELETE + assistant
        if fault in (KEPT, CUT):
            more = TRUNCATED if fault == CUT else 0
            as_user = more + assistant + (0 if initial == "u" else REROLE)
            here_u = min(here_u, as_user)
            here_a = min(here_a, more + user + (0 if initial == "a" else REROLE))
            here_f = min(here_f, as_user, more + user if initial == "s" else NEVER)
        user, assistant = min(here_u, INSERT + here_a), min(here_a, INSERT + here_u)
        fresh = min(here_f, INSERT + assistant)
        out.append((fresh, user, assistant, user))
    out.reverse()
    return out


def repair(initials: list[str], faults: list[int]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, of several the ASCII-least audit."""
    n = len(initials)
    guess = _estimates(initials, faults)
    failed: dict[tuple[int, int], int] = {}

    def edits(row: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(initial, cost, next row, next state) in ASCII order."""
        if row < n:
            yield "D", DELETE, row + 1, state
        yield "I", INSERT, row, STEP[state, WANTED[state]]
        if row < n and faults[row] in (KEPT, CUT):
            more = TRUNCATED if faults[row] == CUT else 0
            kept = STEP.get((state, initials[row]))
            if kept is not None:
                yield "K", more, row + 1, kept
            yield "R", more + REROLE, row + 1, STEP[state, WANTED[state]]

    bound = guess[0][START]
    while True:
        beyond = NEVER
        path: list[str] = []
        stack = [(0, START, bound, edits(0, START))]
        while stack:
            row, state, budget, ways = stack[-1]
            if row == n and state in ACCEPTING:
                return bound - budget, "".join(path)
            for initial, cost, after, then in ways:
                left = budget - cost
                need = guess[after][then]
                if need > left:
                    beyond = min(beyond, bound + need - left)
                elif failed.get((after, then), -1) < left:
                    path.append(initial)
                    stack.append((after, then, left, edits(after, then)))
                    break
                # A state that failed with this budget was seen to exceed it in an
                # earlier bound or branch; one more unit may be what it lacks.
                else:
                    beyond = min(beyond, bound + failed[after, then] - left + 1)
            else:
                failed[row, state] = max(budget, failed.get((row, state), -1))
                stack.pop()
                if path:
                    path.pop()
        bound = beyond


def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the damage, by crc32(``conv_id:turn``) modulo 20.

    A null counts as one space, in that key too.  ``copy`` numbers a row and its
    repetition; a dropped row stays as a row with ``copy`` -1, so that its
    conversation is still known.
    """
    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        text("role").alias("role"), text("text").alias("text"),
        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("harm"))
    copies = (F.when(F.col("harm") == 0, F.array(F.lit(-1)))
              .when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("harm") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, F.lit(""))
        .when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy"))


def _in_order(rows: DataFrame, first: tuple = ()) -> DataFrame:
    """Each conversation in one partition, one after another, its rows by turn (nulls first);
    rows that share a turn by role and text."""
    order = [F.col("conv_id").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(),
             F.col("role"), F.col("text"), F.col("copy")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


AUDITS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string")


class _Conversation:
    """What the first stream keeps of the conversation at hand."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.initials: list[str] = []
        self.faults: list[int] = []
        self.seen: set[bytes] = set()
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn: int | None, role: str, digest: bytes, blank: bool, cut: bool) -> None:
        if turn is not None and turn != self.high:  # rows come by turn
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        self.initials.append(role[:1])
        self.faults.append(BLANK if blank else DUPLICATE if digest in self.seen
                           else CUT if cut else KEPT)
        self.seen.add(digest)

    def row(self) -> tuple:
        cost, audit = repair(self.initials, self.faults)
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        count = [self.faults.count(f) for f in (BLANK, DUPLICATE, CUT)]
        illegal = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:]))
        return (self.conv_id, gaps, *count, illegal, cost, audit)


def find_repairs(rows: DataFrame) -> DataFrame:
    """One row of ``AUDITS`` for each conversation of the damaged rows."""
    light = _in_order(rows).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("role"), "copy",
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
        .alias("digest"),
        (~F.col("text").rlike(f"[^{BLANKS}]")).alias("blank"),
        F.col("text").rlike(f"[^.!?{BLANKS}][{BLANKS}]*+\\z").alias("cut"))

    schema = arrow_schema(T.StructType.fromDDL(AUDITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now, done = schema.names, None, []
        for batch in batches:
            for conv, turn, role, copy, digest, blank, cut in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Conversation(conv)
                if copy >= 0:
                    now.add(turn, role, digest, blank, cut)
            if done:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema)
                done = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, now.row()))], schema)

    return light.mapInArrow(run, AUDITS)


class _Writer:
    """Carries out an audit on the rows of a conversation and hashes what comes out."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, START
        self.sha, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1
        self.state = STEP[self.state, role[:1]]

    def insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._line("user" if WANTED[self.state] == "u" else "assistant", "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._line(role, text)
        elif edit == "R":
            self._line("user" if WANTED[self.state] == "u" else "assistant", text)

    def row(self) -> tuple[int | None, str]:
        self.insert()
        return self.conv_id, self.sha.hexdigest()


def hash_repairs(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the edits of ``audits`` carried out on the rows."""
    leads = audits.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), F.lit(-1).alias("copy"), "audit")
    marked = rows.filter("copy >= 0").withColumn("audit", F.lit(None).cast("string"))
    stream = _in_order(marked.unionByName(leads), (F.col("audit").isNull(),)) \
        .select("conv_id", "role", "text", "audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, hashes = None, [], []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()),
                                               pa.array(hashes, pa.string())],
                                              names=["id", "repaired_sha256"])
        for batch in batches:
            for conv, role, text, audit in zip(*(c.to_pylist() for c in batch.columns)):
                if audit is not None:  # the row that leads its conversation
                    if now is not None:
                        ids.append(now.conv_id)
                        hashes.append(now.row()[1])
                    now = _Writer(conv, audit)
                else:
                    now.add(role, text)
            yield out()
            ids, hashes = [], []
        if now is not None:
            ids, hashes = [now.conv_id], [now.row()[1]]
            yield out()

    return stream.mapInArrow(run, "id long, repaired_sha256 string")


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations`` (a null is a conversation of its own) with its
    faults, the cost and audit of its cheapest repair and the hash of the repaired rows.

    Nulls count as one space; an empty table gives no rows; other columns are
    ignored.  Repeated rows are duplicates of the first; rows that share a turn are
    taken by role and text.  A conversation without rows after the damage, or
    repaired to nothing, has the hash of the empty text.
    """
    rows = damage(conversations)
    audits = save(find_repairs(rows), "conversation-audits")
    hashes = hash_repairs(rows, audits)
    return audits.join(hashes, audits.conv_id.eqNullSafe(hashes.id)).drop("id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(read_table(spark, sf_dir, "conversations"))
