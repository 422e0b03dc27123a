"""Repair of conversations against plain search over all edits."""

import hashlib
import itertools
import random
import zlib
from functools import cache

from hypothesis import given, settings
from hypothesis import strategies as st

from voltaweave.llm import repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, mark int, said string, part string"
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}


def plain(marks):
    """(cost, audit) by a search over states, edit by edit."""

    @cache
    def best(i, state, inserted):
        found = [(0, "")] if i == len(marks) and state in (0, 3) else []
        expected = 3 if state == 2 else 2
        steps = [(5, "I", i, expected, inserted + 1)] if inserted < 3 else []
        if i < len(marks):
            steps.append((2, "D", i + 1, state, 0))
            if not marks[i] & repair.MUST_GO:
                cut, own = 5 * bool(marks[i] & repair.IS_CUT), marks[i] & 3
                steps.append((1 + cut, "R", i + 1, expected, 0))
                if own in NEXT[state]:
                    steps.append((cut, "K", i + 1, own, 0))
        for cost, letter, *then in steps:
            rest = best(*then)
            if rest:
                found.append((cost + rest[0], letter + rest[1]))
        return min(found) if found else None

    return best(0, 0, 0)


def test_all_short_conversations():
    for n in range(5):
        for marks in itertools.product([0, 1, 2, 3, 16, 17, 18, 19, 4], repeat=n):
            assert repair.cheapest(bytes(marks)) == plain(marks)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([r | f for r in range(4) for f in (0, 0, 0, 4, 8, 16)]), max_size=16))
def test_random_conversations(marks):
    assert repair.cheapest(bytes(marks)) == plain(tuple(marks))


def brute(rows):
    """The whole result for rows of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        said = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            spaced = lambda x: " " if x is None else str(x)
            fault = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
            role, text = spaced(role), spaced(text)
            text = "" if fault == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if fault == 2 else text
            said += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        marks, counts, seen = [], {4: 0, 8: 0, 16: 0}, set()
        for _, role, text in said:
            t = text.strip(SPACE)
            fault = 4 if not t else 8 if (role, text) in seen else 16 if t[-1] not in ".!?" else 0
            seen.add((role, text))
            marks.append({"s": 1, "u": 2, "a": 3}.get(role[:1], 0) | fault)
            if fault:
                counts[fault] += 1
        cost, audit = plain(tuple(marks))
        lines, state, at = [], 0, 0
        for letter in audit:
            expected = 3 if state == 2 else 2
            if letter == "I":
                lines.append(f"{repair.NAMES[expected]}:")
                state = expected
                continue
            _, role, text = said[at]
            if letter == "K":
                lines.append(f"{role}:{text}")
                state = marks[at] & 3
            elif letter == "R":
                lines.append(f"{repair.NAMES[expected]}:{text}")
                state = expected
            at += 1
        turns = [r[0] for r in said if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(said, said[1:], strict=False)]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv] = (gaps, counts[4], counts[8], counts[16], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "a", "b") for r in rows], SCHEMA).repartition(parts)
    got = repair.repair(repair.damaged(df)).collect()
    assert len(got) == len({r[0] for r in rows})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}


def test_awkward_rows(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No", "  ", "", None, "Ends here!\n\t", "Is it? ", "é…", "Long. " * 5000, "x" * 70_000, "Same.", "Same.", "a\nb.", "Trailing "]
    roles = ["user", "assistant", "system", None, "", "tool", "agent", "User", "user"]
    rows = []
    for conv in [None, -7, *range(120)]:
        for _ in range(rng.randint(1, 9)):
            row = (conv, rng.choice([None, *range(6), 2**40]), rng.choice(roles if conv != 5 else roles[:3]), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2, 3])
    rows += [(500, t, "user", "All the same.") for t in range(60)] + [(501, None, None, None)]
    assert results(spark, rows) == brute(rows)
    assert results(spark, rows, 1) == results(spark, rows, 7)


def test_wholly_dropped(spark):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = results(spark, [(conv, 0, "user", "Hello.")])
    assert got == {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty(spark):
    assert results(spark, []) == {}


def test_one_long_conversation(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{rng.choice(['One', 'Two', 'Three'])} {rng.randint(0, 3000)}{rng.choice('.. ?')}") for t in range(30_000)]
    got = results(spark, rows, 6)[1]
    kept = [r for r in rows if zlib.crc32(f"1:{r[1]}".encode()) % 20]
    assert got[0] == kept[-1][1] - kept[0][1] + 1 - len(kept)
    assert sum(got[6].count(x) for x in "DKR") == len(kept) + sum(zlib.crc32(f"1:{r[1]}".encode()) % 20 == 3 for r in kept)
