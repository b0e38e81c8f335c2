"""Conversation repair against a plain search over all edits, row by row."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import duckdb
import pytest

from llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, signature string, cost string, is_row int"
BLANK = " \t\n\x0b\x0c\r"


sys.setrecursionlimit(20_000)


def cheapest(roles, texts, faults):
    """Least (cost, audit, lines) over edits; tries whole audits, so it shares no step with the automaton."""
    n = len(roles)

    @lru_cache(None)
    def rest(i, state, inserted):
        found = [(0, "", ())] if i == n and state in "_a" else []
        after = {"_": "u", "s": "u", "u": "a", "a": "u"}[state]
        name = {"u": "user", "a": "assistant"}[after]
        if inserted < 3:
            c, a, lines = rest(i, after, inserted + 1)
            found.append((c + 5, "I" + a, (name + ":", *lines)))
        if i < n:
            c, a, lines = rest(i + 1, state, 0)
            found.append((c + 2, "D" + a, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                c, a, lines = rest(i + 1, after, 0)
                found.append((c + 1 + more, "R" + a, (f"{name}:{texts[i]}", *lines)))
                if roles[i][:1] == after or (roles[i][:1] == "s" and state == "_"):
                    c, a, lines = rest(i + 1, roles[i][0], 0)
                    found.append((c + more, "K" + a, (f"{roles[i]}:{texts[i]}", *lines)))
        return min(found, default=(1 << 50, "~", ()), key=lambda f: f[:2])

    return rest(0, "_", 0)


def expected(rows):
    by_conv = {}
    for conv, turn, role, text in rows:
        out = by_conv.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    result = set()
    for conv, out in by_conv.items():
        whose = "-" if conv is None else f"={conv}"
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{whose}\0{r[1]}\0{r[2]}".encode()).digest()))
        faults, seen = [], set()
        for _, role, text in out:
            last = text.rstrip(BLANK)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, *_ in out if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:], strict=False))
        cost, audit, lines = cheapest([r[1] for r in out], [r[2] for r in out], faults)
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        result.add((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return result


def conversations(seed, n):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "unknown", "s", "", "User", None]
    texts = ["Yes.", "No!", "cut off", "Why?", "", " \t\n", None, "Done. \n", "é.", "e ", "."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            t = rng.choice([turn, turn, turn, None, turn * 3, -turn])
            rows.append((conv, t, rng.choice(roles[:3] * 4 + roles), rng.choice(texts + [f"Line {rng.randrange(30)}."] * 12)))
    return rows


@pytest.fixture(scope="module")
def rows():
    rows = conversations(1, 150)
    rows += [(None, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(6)]
    rows += [(1000, 5, "user", "Same."), (1000, 5, "user", "Same."), (1000, 5, "user", "Same."), (1000, 5, "assistant", "Same.")]
    rows += [(1001, None, None, None), (1002, 7, "assistant", "x " * 200_000 + "."), (1003, -(1 << 40), "system", "Hm."), (1003, 1 << 40, "user", "Hm.")]
    rows += [(2000, t, ("user", "assistant")[t % 2], f"Said {t % 40}." if t % 3 else "and") for t in range(300)]
    rows += [(2001 + c, t, ("user", "assistant")[t % 2], "The same.") for c in range(40) for t in range(4)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)


def test_report_equals_search(spark, rows):
    got = repair.repair_report(frame(spark, rows))
    assert {tuple(r) for r in got.collect()} == expected(rows)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_pieces_of_a_conversation_are_put_together(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = repair.repair_report(frame(spark, rows))
        assert {tuple(r) for r in got.collect()} == expected(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sql_agrees(spark, rows):
    import pyarrow as pa

    rows = [r for r in rows if r[0] != 2000 and len(r[3] or "") < 1000]
    columns = zip(*rows, strict=True)
    conversations = pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.string(), pa.string()], strict=True)], ["conv_id", "turn", "role", "text"])
    db = duckdb.connect()
    db.register("conversations", conversations)
    assert set(db.execute(repair.REPORT_SQL).fetchall()) == expected(rows)


def test_repaired_rows_are_what_is_hashed(spark, rows):
    damaged = repair.damage(frame(spark, rows))
    planned = repair.plans(repair.profiles(damaged))
    got = {}
    for r in repair.repaired(damaged, planned).collect():
        got.setdefault(r.conv_id, []).append((r.position, f"{r.role}:{r.text}", r.edit))
    hashes = {e[0]: (e[7], e[8]) for e in expected(rows)}
    for conv, lines in got.items():
        assert [p for p, *_ in sorted(lines)] == list(range(len(lines)))
        audit, digest = hashes[conv]
        assert "".join(e for *_, e in sorted(lines)) == audit.replace("D", "")
        assert hashlib.sha256("\n".join(t for _, t, _ in sorted(lines)).encode()).hexdigest() == digest
    assert all(set(audit) <= {"D"} for conv, (audit, _) in hashes.items() if conv not in got)


def test_suffixes_are_made_once():
    signatures = sorted(("".join(random.Random(i).choices("suaoSUAOx", k=i % 9)) for i in range(3000)), key=lambda s: s[::-1])
    dawg = repair.Dawg()
    for s in signatures:
        dawg.plan(s)
    assert dawg.made == len({s[k:] for s in signatures for k in range(len(s))})
    assert len(dawg.moves) < 600


def test_long_signature_and_no_rows(spark):
    cost, audit = repair.Dawg().plan("ua" * 200_000)
    assert (cost, audit) == (0, "K" * 400_000)
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair_report(none).collect() == []
