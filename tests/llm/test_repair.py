"""Conversation repair against exhaustive search over all edits and against a plain table of paths."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest
from plain import SMALL

from tillwise.llm import repair
from tillwise.llm.queries import QUERIES

LEGAL = re.compile("(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string"


def damage(rows):
    out: dict = {}
    for conv, turn, role, text in rows:
        show = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(show).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in out.items()}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else None if last in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, edits, repaired lines): the least of whole paths, all kept, into each last initial."""
    paths = {"": (0, "", [])}  # by the roles so far: nothing, s, u, a

    def said(state):
        return "assistant" if state == "u" else "user"

    def better(into, state, path):
        if state not in into or path[:2] < into[state][:2]:
            into[state] = path

    def inserted(paths):
        for _ in range(2):
            for state, (cost, edits, lines) in list(paths.items()):
                role = said(state)
                better(paths, role[0], (cost + 5, edits + "I", [*lines, f"{role}:"]))
        return paths

    for (_, role, text), fault in zip(rows, found):
        new: dict = {}
        for state, (cost, edits, lines) in inserted(paths).items():
            better(new, state, (cost + 2, edits + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += 5 * (fault == "truncated")
            other = said(state)
            better(new, other[0], (cost + 1, edits + "R", [*lines, f"{other}:{text}"]))
            if role[:1] == other[0] or (role[:1] == "s" and state == ""):
                better(new, role[0], (cost, edits + "K", [*lines, f"{role}:{text}"]))
        paths = new
    ends = [p for state, p in inserted(paths).items() if state in ("", "a")]
    return min(ends, key=lambda p: p[:2])


def every(rows, found):
    """Least (cost, edits) over all edit strings with at most two insertions in a gap."""
    best = None
    for gaps in itertools.product(range(3), repeat=len(rows) + 1):
        for chosen in itertools.product("KRD", repeat=len(rows)):
            cost = 5 * sum(gaps)
            slots = ["?"] * gaps[0]
            edits = "I" * gaps[0]
            ok = True
            for n, (edit, fault, (_, role, _)) in enumerate(zip(chosen, found, rows)):
                ok = ok and (edit == "D" or fault not in ("blank", "duplicate"))
                cost += {"K": 0, "R": 1, "D": 2}[edit] + 5 * (edit != "D" and fault == "truncated")
                slots += {"K": [role[:1]], "R": ["?"], "D": []}[edit] + ["?"] * gaps[n + 1]
                edits += edit + "I" * gaps[n + 1]
            if ok and (best is None or (cost, edits) < best):
                if any(
                    all(s in ("?", r) for s, r in zip(slots, roles))
                    for roles in ("ua" * (len(slots) // 2), "s" + "ua" * (len(slots) // 2))
                    if len(roles) == len(slots) and LEGAL.fullmatch(roles) and not (roles[:1] == "s" and slots[0] == "?")
                ):
                    best = cost, edits
    return best


def expected(conversations):
    out = []
    by_conv = damage(conversations)
    for conv, rows in by_conv.items():
        found = faults(rows)
        cost, edits, lines = cheapest(rows, found)
        turns = [t for t, _, _ in rows if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, edits,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return out


def test_plain_version_is_exhaustive():
    draw = random.Random(3)
    for _ in range(40):
        rows = [(n, draw.choice(["system", "user", "assistant", "tool"]), draw.choice(["", "x", "y."])) for n in range(draw.randint(0, 4))]
        found = [draw.choice([None, None, f]) if f != "blank" else f for f in faults(rows)]
        assert cheapest(rows, found)[:2] == every(rows, found)


@pytest.mark.parametrize("seed", range(4))
def test_stream_equals_whole_paths(seed):
    draw = random.Random(seed)
    for _ in range(400):
        rows = [
            (n, draw.choice(["system", "user", "user", "assistant", "assistant", "", "tool"]), draw.choice(["", "x", "y.", f"{n}.", f"{n}!"]))
            for n in range(draw.randint(0, 40))
        ]
        found = faults(rows)
        one, edits, lines = repair.Repair(), "", []
        for (_, role, text), fault in zip(rows, found):
            for edit, times, said, what in one.push(role, text, fault):
                edits += edit * times
                lines += [] if edit == "D" else [f"{said}:{what}"]
        last, cost = one.finish()
        for edit, times, said, what in last:
            edits += edit * times
            lines += [] if edit == "D" else [f"{said}:{what}"]
        assert (cost, edits, lines) == cheapest(rows, found)


def test_unresolved_edits_stay_few():
    """Long conversations, also of deletions and of unending ties, hold a handful of nodes."""
    draw = random.Random(1)
    kinds = {
        "alternating": lambda n: (("user", "assistant")[n % 2], "x.", None),
        "repeats": lambda n: ("user", "x.", None if n < 3 else "duplicate"),
        "cut off": lambda n: (("user", "assistant")[n % 2], "x", "truncated"),
        "mixed": lambda n: (draw.choice(["user", "assistant", "system"]), "x", draw.choice([None, "blank", "truncated"])),
    }
    for row in kinds.values():
        one, most = repair.Repair(), 0
        for n in range(20_000):
            one.push(*row(n))
            nodes = set()
            for _, node, _ in one.paths.values():
                while node is not one.root:
                    nodes.add(id(node))
                    node = node.parent
            most = max(most, len(nodes))
        assert most < 500  # of 20,000 rows


def test_query_on_the_whole_table(spark):
    table = pq.read_table(f"{SMALL}/conversations.parquet").to_pylist()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table]
    got = [tuple(r) for r in QUERIES["op13_conversation_repair"](spark, SMALL).collect()]
    assert sorted(got) == sorted(expected(rows)) and len({r[6] for r in got}) > 3


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, repeated rows, a long text, other columns."""
    rows = [(None, n, None if n % 4 == 0 else "user", None if n % 5 == 0 else f"t{n}.") for n in range(12)]
    rows += [(1, None, "user", "a."), (1, None, "user", "a."), (1, None, "user", "a.")]
    rows += [(2, 5, "system", "s."), (2, -(1 << 62), "user", "x " * 50_000 + "?"), (2, 1 << 62, "assistant", "\t\n")]
    rows += [(3, n, "assistant", "é.") for n in range(30)] + [(4, n % 3, "user", "b!") for n in range(9)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", edit string, cost int")
    got = [tuple(r) for r in repair.reports(repair.repair_edits(repair.damaged(frame))).collect()]
    columns = repair.reports(repair.repair_edits(repair.damaged(frame))).columns
    order = [columns.index(c) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")]
    got = [tuple(r[i] for i in order) for r in got]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_all_rows_dropped_and_no_rows(spark):
    gone = next(n for n in range(1000) if zlib.crc32(f"9:{n}".encode()) % 20 == 0)
    one = repair.reports(repair.repair_edits(repair.damaged(spark.createDataFrame([(9, gone, "user", "a.")], ROWS)))).collect()
    assert [(r.conv_id, r.cost, r.gaps, r.audit) for r in one] == [(9, 0, 0, "")]
    assert one[0].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair.reports(repair.repair_edits(spark.createDataFrame([], ROWS))).count() == 0


def test_repaired_rows_alternate(spark):
    rows = [(1, 0, "user", "hello?"), (1, 1, "user", "again?"), (1, 2, "assistant", "yes."), (2, 0, "assistant", "so.")]
    got = repair.repaired(spark.createDataFrame(rows, ROWS)).orderBy("conv_id", "place").collect()
    for conv in (1, 2):
        assert LEGAL.fullmatch("".join(r.role[0] for r in got if r.conv_id == conv))
