"""Conversation structure repair: the cheapest edits that make roles alternate, as they stream by.

A Viterbi pass over the rows of a conversation keeps the cheapest path into each of four states:
nothing yet, system said, user said, assistant said. Paths are a tree of backpointers with reference
counts. A path that wins nowhere gives its nodes back; once the root has one child left, all
survivors share that edit, which is emitted and forgotten. Paths of equal cost are compared by their
whole unresolved suffixes, whose order each path carries along as a rank, so the result is the least
of all cheapest edit strings, as if no edit had been emitted early.

Little stays unresolved in a conversation of any length. A state goes once another can do all that it
can for less (``REACH``), and a run of deletions at the end of a path is one node with a count. Only
where the last row decides between two readings (one role alone speaks throughout) are the edits
between held until then, as any exact method has to.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the contract.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Ways from a state to others by insertions in front of a row: state, edits.
INSERTIONS = {
    NOTHING: ((NOTHING, ""), (USER, "I"), (ASSISTANT, "II")),
    SYSTEM: ((SYSTEM, ""), (USER, "I"), (ASSISTANT, "II")),
    USER: ((USER, ""), (ASSISTANT, "I")),
    ASSISTANT: ((ASSISTANT, ""), (USER, "I")),
}
#: What it costs at most to do from the first state all that can be done from the second.
REACH = {
    (NOTHING, SYSTEM): 0, (NOTHING, ASSISTANT): 0, (NOTHING, USER): INSERT,
    (ASSISTANT, SYSTEM): 0, (ASSISTANT, NOTHING): DELETE, (ASSISTANT, USER): INSERT,
    (USER, ASSISTANT): INSERT, (USER, SYSTEM): INSERT, (USER, NOTHING): INSERT + DELETE,
    (SYSTEM, USER): INSERT, (SYSTEM, ASSISTANT): 2 * INSERT, (SYSTEM, NOTHING): 2 * INSERT + DELETE,
}
#: Edit rows handed on at a time, and about how many characters of text.
FLUSH_ROWS, FLUSH_CHARS = 4096, 4 << 20


def _after(state: int) -> int:
    """The state after one more turn of user or assistant, whichever fits."""
    return ASSISTANT if state == USER else USER


def _moves(initial: str, fault: str | None) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, edits) of every way over a row."""
    out = []
    for start, ways in INSERTIONS.items():
        for state, inserted in ways:
            paid = INSERT * len(inserted)
            out.append((start, state, paid + DELETE, inserted + "D"))
            if fault in (BLANK, DUPLICATE):
                continue
            paid += CUT_OFF if fault == TRUNCATED else 0
            out.append((start, _after(state), paid + REROLE, inserted + "R"))
            if initial == "s" and state == NOTHING:
                out.append((start, SYSTEM, paid + KEEP, inserted + "K"))
            if initial == ("a" if state == USER else "u"):
                out.append((start, _after(state), paid + KEEP, inserted + "K"))
    return out


MOVES = {
    (initial, fault): _moves(initial, fault)
    for initial in ("s", "u", "a", "")
    for fault in (None, BLANK, DUPLICATE, TRUNCATED)
}


class Node:
    """An edit of a path; ``times`` counts a run of deletions, ``refs`` children and states."""

    __slots__ = ("parent", "edit", "times", "role", "text", "refs")

    def __init__(self, parent, edit="", role=None, text=None):
        self.parent, self.edit, self.times, self.role, self.text, self.refs = parent, edit, 1, role, text, 0
        if parent is not None:
            parent.refs += 1


class Repair:
    """One conversation: ``push`` its rows in order, then ``finish``. Both return (edit, times,
    role, text) of the edits that are certain by then."""

    def __init__(self):
        self.root = Node(None)
        self.root.refs = 1
        # Cost, last edit, and the rank of the whole edit string among the living ones, by state.
        self.paths: dict[int, tuple[int, Node, int]] = {NOTHING: (0, self.root, 0)}

    def _best(self, candidates) -> dict[int, tuple[int, int, str, Node, int]]:
        """The cheapest, then least, candidate (cost, rank, edits, node, from) of each target state.

        Strings of one length in rows are never each other's beginning, so those of two paths compare
        as they did before the row, and only extensions of one path compare by their new edits.
        """
        best: dict[int, tuple[int, int, str, Node, int]] = {}
        for start, to, cost, edits in candidates:
            known = self.paths.get(start)
            if known is not None:
                new = (known[0] + cost, known[2], edits, known[1], start)
                old = best.get(to)
                if old is None or new[:3] < old[:3]:
                    best[to] = new
        return best

    def push(self, role: str, text: str, fault: str | None):
        initial = role[:1]
        best = self._best(MOVES[initial if initial in ("s", "u", "a") else "", fault])
        alive = {
            to: found
            for to, found in best.items()
            if not any(other != to and best[other][0] + REACH[other, to] < found[0] for other in best)
        }
        uses = [id(found[3]) for found in alive.values()]
        held = [path[1] for path in self.paths.values()]
        ranks = {to: n for n, to in enumerate(sorted(alive, key=lambda to: alive[to][1:3]))}
        paths = {}
        for to, (cost, _, edits, node, state) in alive.items():
            if edits == "D" == node.edit and uses.count(id(node)) == 1 and node.refs == 1:
                node.times += 1  # held by this path alone
            else:
                node = self._extended(node, state, edits, role, text)
            node.refs += 1
            paths[to] = (cost, node, ranks[to])
        self.paths = paths
        for node in held:
            self._release(node)
        return self._settled()

    def _extended(self, node: Node, state: int, edits: str, role: str | None, text: str | None) -> Node:
        for edit in edits:
            if edit == "D":
                node = Node(node, edit)
                continue
            said = "assistant" if state == USER else "user"
            if edit == "K":
                node = Node(node, edit, role, text)
            else:
                node = Node(node, edit, said, text if edit == "R" else "")
            state = SYSTEM if edit == "K" and state == NOTHING and role[:1] == "s" else _after(state)
        return node

    @staticmethod
    def _release(node: Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            node = node.parent
            node.refs -= 1

    def _settled(self):
        """Edits from the root on that all paths share."""
        if self.root.refs > 1:
            return []
        node, chain = next(iter(self.paths.values()))[1], []
        while node is not self.root:
            chain.append(node)
            node = node.parent
        out = []
        while chain and self.root.refs == 1 and not self._open_run(chain[-1]):
            self.root = chain.pop()
            self.root.parent = None
            out.append((self.root.edit, self.root.times, self.root.role, self.root.text))
        return out

    def _open_run(self, node: Node) -> bool:
        """A run of deletions at the end of a path may still grow in place."""
        return node.edit == "D" and any(node is path[1] for path in self.paths.values())

    def finish(self):
        """The last edits and the cost of all."""
        ends = ((NOTHING, NOTHING, 0, ""), (SYSTEM, NOTHING, 2 * INSERT, "II"),
                (USER, NOTHING, INSERT, "I"), (ASSISTANT, NOTHING, 0, ""))
        cost, _, edits, node, state = self._best(ends)[NOTHING]
        node, out = self._extended(node, state, edits, None, None), []
        while node is not self.root:
            out.append((node.edit, node.times, node.role, node.text))
            node = node.parent
        return out[::-1], cost


def _clipped(value: int) -> int:
    return max(-(1 << 63), min(value, (1 << 63) - 1))


class Report:
    """Counts over the rows of a conversation in order of turns."""

    def __init__(self):
        self.faults = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED), 0)
        self.illegal = self.distinct = 0
        self.low = self.turn = self.initial = None

    def push(self, turn: int | None, role: str, fault: str | None) -> None:
        if fault:
            self.faults[fault] += 1
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn = turn
            self.distinct += 1

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else _clipped(self.turn - self.low + 1 - self.distinct)


def faulty(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``present`` and ``fault`` of every row, one
    conversation after another in each partition and by turn (nulls first) inside it.

    Rows of one turn follow each other by role and a hash of the text. The first fault counts: blank,
    duplicate (role and text stand in an earlier row of the conversation) or truncated. Rows that are
    not ``present`` only name their conversation.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    digest = F.struct(F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "text", "role"))
    # One shuffle: the window's key includes conv_id, so rows stay where they are.
    first = Window.partitionBy("conv_id", "present", "_digest").orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(trimmed == "", BLANK)
        .when(F.col("_seen") > 1, DUPLICATE)
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED)
    )
    return (
        rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "present")
        .repartition("conv_id")
        .withColumn("_digest", digest)
        .withColumn("_seen", F.row_number().over(first))
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "_digest", "_seen")
        .select("conv_id", "turn", "role", "text", "present", fault.alias("fault"))
    )


_EDITS = (
    "place long, edit string, times long, role string, text string, gaps long, blank long,"
    " duplicate long, truncated long, illegal long, cost long"
)


def repair_edits(rows: DataFrame) -> DataFrame:
    """Edits of every conversation of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``, and
    optionally ``present``; other columns are ignored, null roles and texts are one space).

    One row per edit in order, ``place`` counting them: ``edit`` is K(eep), R(erole), I(nsert) with the
    repaired ``role`` and ``text``, or D(elete) for ``times`` rows. A last row per conversation has no
    edit; it carries the counts of faults and the total ``cost``. Rows of a conversation follow each
    other in their partition. A null conv_id is a conversation of its own; an empty table has no rows.
    """
    if "present" not in rows.columns:
        rows = rows.withColumn("present", F.lit(True))
    space = F.lit(" ")
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text")})
    conv = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(_EDITS).fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    # Reports are known at the end of a conversation only.
    arrow = to_arrow_schema(schema)

    def run(batches):
        out: list[list] = [[] for _ in arrow]
        chars = place = 0
        conv, repair, report = None, None, None

        def batch():
            nonlocal out, chars
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, arrow)], schema=arrow)
            out, chars = [[] for _ in arrow], 0
            return made

        def emit(edits, ending=None):
            nonlocal chars, place
            for edit in edits:
                for column, value in zip(out, (conv, place, *edit, *[None] * 6)):
                    column.append(value)
                place += 1
                chars += len(edit[3] or "")
            if ending:
                for column, value in zip(out, (conv, place, None, 0, None, None, *ending)):
                    column.append(value)

        def close():
            edits, cost = repair.finish()
            emit(edits, (report.gaps, *report.faults.values(), report.illegal, cost))

        for part in batches:
            for one, turn, role, text, present, fault in zip(*(c.to_pylist() for c in part.columns)):
                if repair is None or one != conv:
                    if repair is not None:
                        close()
                    conv, repair, report, place = one, Repair(), Report(), 0
                if present:
                    report.push(turn, role, fault)
                    emit(repair.push(role, text, fault))
                if len(out[0]) >= FLUSH_ROWS or chars >= FLUSH_CHARS:
                    yield batch()
        if repair is not None:
            close()
        if out[0]:
            yield batch()

    return faulty(rows).mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``place``, ``role`` and ``text`` of the repaired conversations."""
    return repair_edits(rows).where("edit IN ('K', 'R', 'I')").select("conv_id", "place", "role", "text")


def reports(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair_edits``: its counts, cost, the ``audit`` of all edits and
    the hash of the repaired lines. Edits are read as they come, a few at a time."""
    conv = edits.schema["conv_id"]
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType(
        [conv, *[T.StructField(c, T.LongType()) for c in counts],
         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )

    def run(batches):
        audit, digest, lines = [], hashlib.sha256(), 0
        for part in batches:
            rows, ends = part.select(["edit", "times", "role", "text"]), []
            for n, (edit, times, role, text) in enumerate(zip(*(c.to_pylist() for c in rows.columns))):
                if edit is None:
                    ends.append((n, "".join(audit), digest.hexdigest()))
                    audit, digest, lines = [], hashlib.sha256(), 0
                    continue
                audit.append(edit * times)
                if edit != "D":
                    digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            last = part.select(["conv_id", *counts]).take(pa.array([e[0] for e in ends], "int64"))
            for column in (1, 2):
                name = schema.names[len(counts) + column]
                last = last.append_column(name, pa.array([e[column] for e in ends], "string"))
            yield last

    return edits.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with seeded damage: by the row's hash it goes (``present`` is false), loses
    its text or its closing marks, is repeated, or becomes the user's."""
    space = F.lit(" ")

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    kind = F.crc32(F.concat_ws(":", known("conv_id"), known("turn"))) % 20
    return (
        conversations.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), kind.alias("_kind"))
        .withColumn("_copies", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select(
            "conv_id",
            "turn",
            F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("_kind") <= 1, "")
            .when(F.col("_kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            (F.col("_kind") != 0).alias("present"),
        )
    )


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation after seeded damage, with its faults and the cheapest repair."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return reports(repair_edits(damaged(rows))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
