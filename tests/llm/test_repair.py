"""Conversation repair against every sequence of edits of small conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from brakelight.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, copy string, fault string, dropped string"
LEGAL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def judge(rows):
    """Faults of the sorted rows of one conversation."""
    found, seen = [], set()
    for _, _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        seen.add((role, text))
    return found


def every_repair(rows, faults, bound):
    """All (cost, audit, repaired) up to the cost bound whose role initials are legal."""
    def go(i, cost, audit, out):
        if cost > bound:
            return
        if i == len(rows):
            if LEGAL.fullmatch("".join(r[:1] or "?" for r, _ in out)):  # an empty role has no legal initial
                yield cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        else:
            _, _, role, text = rows[i]
            yield from go(i + 1, cost + 2, audit + "D", out)
            if faults[i] not in (1, 2):
                more = cost + (5 if faults[i] == 3 else 0)
                yield from go(i + 1, more, audit + "K", out + [(role, text)])
                for r in ("user", "assistant"):
                    yield from go(i + 1, more + 1, audit + "R", out + [(r, text)])
        for r in ("user", "assistant"):
            yield from go(i, cost + 5, audit + "I", out + [(r, "")])

    return go(0, 0, "", [])


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults = judge(rows)
    cost, audit, text = min(every_repair(rows, faults, 2 * len(rows)))
    turns = {r[1] for r in rows} - {None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2), faults.count(3),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def conversations():
    rng = random.Random(7)
    roles, texts = ["user", "assistant", "system", "tool", "", None], ["Yes.", "no", " \t", "", None, "é ! ", "Why? "]
    rows = [(c, rng.choice([None, *range(-1, 5)]), rng.choice(roles), rng.choice(texts))
            for c in range(150) for _ in range(rng.randrange(1, 6))]
    rows += [(None, t, r, x) for t, r, x in [(0, "user", "Hi."), (1, "assistant", "Hello.")]]
    rows += [(900 + k, t, "user", f"t{t}.") for k in range(4) for t in range(6)]
    return rows


@pytest.mark.parametrize("parts", [1, 5])
def test_repair_matches_every_sequence_of_edits(spark, parts):
    rows = conversations()
    df = spark.createDataFrame([(*r, "c", "f", "d") for r in rows], SCHEMA).repartition(parts)
    got = {r[0]: tuple(r[1:]) for r in repair.repair(repair.damage(df)).collect()}
    after = {c: [] for c, *_ in rows}
    for r in damaged(rows):
        after[r[0]].append(r)
    assert got == {c: expected(x) for c, x in after.items()}


def test_repaired_rows_are_those_of_the_digest(spark):
    df = repair.damage(spark.createDataFrame([(*r, "c", "f", "d") for r in conversations()], SCHEMA))
    digests = {r.conv_id: r.repaired_sha256 for r in repair.repair(df).collect()}
    rows = sorted(repair.repair(df, emit="rows").collect(), key=lambda r: (r.conv_id is not None, r.conv_id or 0, r.position))
    for conv, group in itertools.groupby(rows, key=lambda r: r.conv_id):
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in group).encode()).hexdigest() == digests.pop(conv)
    assert set(digests.values()) <= {hashlib.sha256(b"").hexdigest()}


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damage(none)).collect() == []


def test_settled_edits_leave_the_tree():
    r, size = repair.Repair(), 0

    def nodes(n):
        return 1 + sum(map(nodes, n.kids))

    for i in range(5000):
        r.add(i, "user" if i % 2 == 0 else "assistant", f"text {i}.", 3 if i % 97 == 5 else 0)
        size = max(size, nodes(r.root))
    cost, audit, _ = r.end()
    assert size < 40 and len(audit) - audit.count("I") == 5000


def test_ranks_order_tied_survivors_like_their_complete_audits():
    """Conversations of users only keep two survivors for ever; ranks must still order complete audits."""
    for n in range(1, 9):
        rows = [(0, t, "user", f"t{t}.") for t in range(n)]
        r = repair.Repair()
        for _, t, role, text in rows:
            r.add(t, role, text, 0)
        assert r.end()[:2] == min(every_repair(rows, [0] * n, 2 * n))[:2]
