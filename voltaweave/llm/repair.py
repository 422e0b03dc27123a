"""Repair of conversations whose rows were lost, emptied, cut, repeated or given to the wrong speaker.

Which turns to keep, reassign, delete or insert is a shortest path over the turns
that stay.  From the last row to the first, the cheapest rest after a retained
turn is known by that turn's role: the cost of all deletions up to a row is a
prefix sum, so that a gap costs the difference of two; for each role a running
minimum holds the best next retained turn; and the pair of roles tells how many
empty turns go between the two.  A row costs the same few steps however long its
conversation is.  Of equally cheap repairs the one whose audit is least wins: a
later next turn before an earlier one (``D`` is the least letter), then more
inserted turns, then a kept turn before a reassigned one.

Rows are ordered by turn (nulls first), role and the text's MD5.  A null role or
text is one space.  A null ``conv_id`` is a conversation like any other.  Repeated rows
are duplicates.  Texts are read whole.  Empty tables give an empty result.

Rows meet in two streams sorted by conversation: one carries a few bytes a row
and yields the audit, the other the texts and yields the repaired conversation,
row by row.  Neither holds a conversation's texts; the first holds some bytes a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

SPACES = " \t\n\x0b\x0c\r"
DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5

#: Roles a retained turn may end up with, and the state before any turn.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: INSERTS[last][next]: the empty turns between two retained ones, or None if nothing can stand between them.
INSERTS = {
    START: {SYSTEM: (), USER: (), ASSISTANT: (USER,)},
    SYSTEM: {SYSTEM: None, USER: (), ASSISTANT: (USER,)},
    USER: {SYSTEM: None, USER: (ASSISTANT,), ASSISTANT: ()},
    ASSISTANT: {SYSTEM: None, USER: (), ASSISTANT: (USER,)},
}
#: The empty turns after the last retained one.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}

#: A row in one byte: its initial's state in the low two bits (0 if it is none of them), and its fault.
IS_BLANK, IS_REPEATED, IS_CUT = 4, 8, 16
MUST_GO = IS_BLANK | IS_REPEATED
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) after faults that a hash of conversation and turn deals out: emptied, unstopped, repeated or user's rows.

    A dropped row stays as one whose role is null, so that no conversation is lost.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20
    texts = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").when(F.col("fault") != 0, F.col("role"))
    dealt = rows.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), spaced(role_col).alias("role"), spaced(text_col).alias("text"), fault.alias("fault")
    )
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return dealt.select("conv_id", "turn", role.alias("role"), F.when(F.col("fault") != 0, texts).alias("text"), copies.alias("copy")).drop("copy")


def marked(rows: DataFrame) -> DataFrame:
    """A few bytes for each distinct row: (conv_id, turn, role, said, copies, mark, copy_mark).

    Rows that are one and the same are counted before the shuffle.  A row is a
    duplicate if its role and text stand earlier: an aggregate finds the first
    turn of those that stand at several, and a join brings it back.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    ends = F.substring(trimmed, -1, 1)
    slim = rows.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("said"), (trimmed == "").alias("blank"), (~ends.isin(".", "!", "?")).alias("cut"))
    slim = written(slim.groupBy("conv_id", "turn", "role", "said", "blank", "cut").agg(F.count(F.lit(1)).alias("copies")), "marks")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = slim.filter("role is not null and not blank").groupBy("conv_id", "role", "said").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    first = first.filter("n > 1").select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("said").alias("_said"), "first")
    met = slim.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("said") == F.col("_said")), "left")
    earlier = F.col("first").isNotNull() & (F.col("first") != place)
    fault = F.when(F.col("blank"), IS_BLANK).when(earlier, IS_REPEATED).when(F.col("cut"), IS_CUT).otherwise(0)
    initial = F.substring("role", 1, 1)
    own = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(0)
    return met.select(
        "conv_id", "turn", "role", "said", "copies", (own + fault).alias("mark"), (own + F.when(F.col("blank"), IS_BLANK).otherwise(IS_REPEATED)).alias("copy_mark")
    )


def cheapest(marks: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of rows, given as one byte each; of several the one with the least audit."""
    n = len(marks)
    taken = bytearray(n)  # two bits for each last role: as what the row is retained if reached with it, 0 if it is deleted
    rest = {last: DELETE * n + INSERT * len(CLOSING[last]) for last in CLOSING}  # all that follows, as if deletions began at the first row
    for i in range(n - 1, -1, -1):
        mark = marks[i]
        if mark & MUST_GO:
            continue
        own, kept = mark & 3, (CUT if mark & IS_CUT else 0) - DELETE  # what comes after the row saves its own deletion
        found = [(rest[role] + kept + (0 if role == own else REROLE), role != own, role) for role in (SYSTEM, USER, ASSISTANT) if role == own or role != SYSTEM]
        lower = dict(rest)
        for last, pairs in INSERTS.items():
            options = [(cost + INSERT * len(pairs[role]), -len(pairs[role]), reroled, role) for cost, reroled, role in found if pairs[role] is not None]
            cost, _, _, role = min(options)
            if cost < rest[last]:
                lower[last] = cost
                taken[i] |= role << (2 * last)
        rest = lower
    return rest[START], "".join(_walk(marks, taken))


def _walk(marks: bytes, taken: bytearray) -> Iterator[str]:
    last = START
    for mark, choice in zip(marks, taken, strict=True):
        role = choice >> (2 * last) & 3
        if role:
            yield "I" * len(INSERTS[last][role]) + ("K" if mark & 3 == role else "R")
            last = role
        else:
            yield "D"
    yield "I" * len(CLOSING[last])


class _Repaired:
    """The hash of a repaired conversation, fed with its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last, self.hash, self.turns = audit, 0, START, hashlib.sha256(), 0

    def _say(self, role: str, said: str, state: int) -> None:
        self.hash.update(("\n" * (self.turns > 0) + f"{role}:{said}").encode("utf-8", "replace"))
        self.turns, self.last = self.turns + 1, state

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            state = ASSISTANT if self.last == USER else USER
            self._say(NAMES[state], "", state)

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._say(role, text, INITIALS[role[0]])
        elif edit == "R":
            state = ASSISTANT if self.last == USER else USER
            self._say(NAMES[state], text, state)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _summary(turns: tuple | None, distinct: int, marks: bytearray) -> dict:
    roles = [m & 3 for m in marks]
    cost, audit = cheapest(marks)
    return {
        "gaps": min(turns[1] - turns[0] + 1 - distinct, 2**63 - 1) if turns else 0,
        "blank": sum(m & IS_BLANK > 0 for m in marks), "duplicate": sum(m & IS_REPEATED > 0 for m in marks), "truncated": sum(m & IS_CUT > 0 for m in marks),
        "illegal": sum(pair not in LEGAL for pair in zip(roles, roles[1:], strict=False)), "cost": cost, "audit": audit,
    }


def audits(marks: DataFrame) -> DataFrame:
    """(conv_id, counts, audit) of each conversation, by one pass over its marks in order."""
    ship(marks.sparkSession)
    kind = marks.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, distinct, held = None, None, 0, bytearray()
        for batch in batches:
            done = []
            for conv, turn, real, copies, mark, copy_mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append({"conv_id": now[0]} | _summary(turns, distinct, held))
                    now, turns, distinct, held = (conv,), None, 0, bytearray()
                if not real:
                    continue
                if turn is not None and (turns is None or turn != turns[1]):
                    turns, distinct = (turns[0] if turns else turn, turn), distinct + 1
                held.append(mark)
                held += bytes([copy_mark]) * (copies - 1)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": now[0]} | _summary(turns, distinct, held)], schema)

    order = marks.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "said")
    rows = order.select("conv_id", "turn", F.col("role").isNotNull().alias("real"), "copies", "mark", "copy_mark")
    schema = pa.schema([("conv_id", _arrow(rows, "conv_id")), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())])
    return rows.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string")


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with the hash of each repaired conversation: the audit goes before the rows of its conversation in one sorted stream."""
    ship(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    heads = found.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), *COUNTS)
    body = rows.filter("role is not null").select("conv_id", F.lit(1).alias("part"), "turn", "role", "text", *(F.lit(None).cast("long").alias(c) for c in COUNTS))
    every = heads.unionByName(body).withColumn("said", F.when(F.col("part") == 1, F.md5(F.col("text").cast("binary"))))
    order = every.repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "said").drop("said", "turn")
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    schema = pa.schema([("conv_id", _arrow(rows, "conv_id")), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, now = None, None
        for batch in batches:
            done = []
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            for i, part in enumerate(column["part"].to_pylist()):
                text = column["text"][i].as_py()
                if part:
                    now.row(column["role"][i].as_py(), text)
                    continue
                if now:
                    done.append(head | {"repaired_sha256": now.digest()})
                head, now = {c: column[c][i].as_py() for c in names[:-2]} | {"audit": text}, _Repaired(text)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if now:
            yield pa.RecordBatch.from_pylist([head | {"repaired_sha256": now.digest()}], schema)

    return order.mapInArrow(run, f"conv_id {kind}, {', '.join(f'{c} long' for c in COUNTS)}, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Each conversation of rows like :func:`damaged` gives: its faults, the cheapest repair's cost and audit, and the repaired text's hash."""
    return repaired(rows, audits(marked(rows)))
