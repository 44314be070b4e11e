"""Conversation repair: the cheapest edits that make a conversation an optional system turn and pairs of user and assistant.

The edits come from Viterbi's algorithm over four states: nothing yet, after the system turn, after a user's turn, after
an assistant's. Each state's best path is a node of a tree of back pointers that counts its references. A node that no
path needs goes at once; when all paths share an ancestor, the edits up to it are final, and are emitted and forgotten.
So memory is that of the turns still open, however long a conversation is. Paths of equal cost are compared by all their
open edits. A conversation's rows stream through one task in order, as its digest of the repaired text is one sequence;
Spark sorts them, on disk if need be, and the task keeps no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmill.sources.workspace import stage

# What an edit costs, and what a truncated turn costs on top if it stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

_WHITE = b" \t\n\v\f\r"
_ENDS = (b".", b"!", b"?")
_LEGAL = {"su", "ua", "au"}

# The states, and what role comes next in each: (role, state after it).
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (("user", _USER), ("user", _USER), ("assistant", _ASSISTANT), ("user", _USER))


class Node:
    """An edit on the path of at least one state. ``refs`` counts the edits that follow it and the states that end in it."""

    __slots__ = ("depth", "edit", "parent", "piece", "refs")

    def __init__(self, parent: Node | None, edit: str, piece: bytes | None):
        self.parent, self.edit, self.piece, self.refs = parent, edit, piece, 0
        self.depth = 0
        if parent is not None:
            self.depth = parent.depth + 1
            parent.refs += 1


def _released(node: Node | None) -> None:
    """Take back a reference; nodes that have none left take back their own."""
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        node.parent, node = None, node.parent


def _before(a: Node, b: Node) -> bool:
    """Whether the edits up to ``a`` come first in ASCII order; both are compared back to where they part."""
    first, second = [], []
    while a is not b:
        if a.depth >= b.depth:
            first.append(a.edit)
            a = a.parent
        else:
            second.append(b.edit)
            b = b.parent
    return first[::-1] < second[::-1]


class Repair:
    """The repair of one conversation, turn by turn: ``turn`` for each row, then ``finish``."""

    def __init__(self):
        self.root = Node(None, "", None)
        self.states: list[tuple[int, Node] | None] = [None] * 4
        self.audit: list[str] = []
        self.digest, self.pieces = hashlib.sha256(), 0
        self.most_open = self.wait = 0
        self.root.refs = 1
        self.states[_START] = (0, self.root)
        self._insert()

    def turn(self, role: str, text: bytes, must_go: bool, truncated: bool) -> None:
        old, new = self.states, [None] * 4
        initial = role[:1]
        extra = TRUNCATED if truncated else 0
        for state, survivor in enumerate(old):
            if survivor is None:
                continue
            cost, node = survivor
            self._offer(new, state, cost + DELETE, node, "D", None)
            if must_go:
                continue
            wanted, after = _NEXT[state]
            if initial == wanted[0]:
                self._offer(new, after, cost + KEEP + extra, node, "K", (role, text))
            else:
                self._offer(new, after, cost + REROLE + extra, node, "R", (wanted, text))
            if initial == "s" and state == _START:
                self._offer(new, _SYSTEM, cost + KEEP + extra, node, "K", (role, text))
        self.states = new
        for survivor in old:
            if survivor is not None:
                _released(survivor[1])
        self._insert()
        self._coalesce()

    def _insert(self) -> None:
        """Empty turns wherever they make a state cheaper."""
        for _ in range(2):
            for state in (_START, _SYSTEM, _ASSISTANT, _USER):
                if self.states[state] is not None:
                    cost, node = self.states[state]
                    role, after = _NEXT[state]
                    self._offer(self.states, after, cost + INSERT, node, "I", (role, b""))

    def _offer(self, states: list, state: int, cost: int, parent: Node, edit: str, piece: tuple | None) -> None:
        present = states[state]
        if present is not None and present[0] < cost:
            return
        node = Node(parent, edit, piece)
        node.refs = 1
        if present is not None:
            if present[0] == cost and not _before(node, present[1]):
                _released(node)
                return
            _released(present[1])
        states[state] = (cost, node)

    def _coalesce(self) -> None:
        """Emit the edits that all paths have in common; looked for again when as much again is half as long."""
        self.wait -= 1
        if self.wait > 0 or self.root.refs > 1:
            return
        path = self._open_path(next(s[1] for s in self.states if s is not None))
        self.most_open = max(self.most_open, len(path))
        emitted = 0
        for node in path:
            if self.root.refs > 1:  # paths part here, or one ends
                break
            self._emit(node)
            emitted += 1
        self.wait = (len(path) - emitted) // 2

    def _open_path(self, node: Node) -> list[Node]:
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        return path[::-1]

    def _emit(self, node: Node) -> None:
        self.audit.append(node.edit)
        if node.piece is not None:
            role, text = node.piece
            self.digest.update((b"\n" if self.pieces else b"") + role.encode() + b":")
            self.digest.update(text)
            self.pieces += 1
        node.parent = node.piece = None
        self.root = node

    def finish(self) -> tuple[int, str, str]:
        """Cost, edits and digest of the cheapest repair."""
        ends = [s for s in (self.states[_START], self.states[_ASSISTANT]) if s is not None]
        least = min(cost for cost, _ in ends)
        tied = [node for cost, node in ends if cost == least]
        best = tied[0] if len(tied) == 1 or _before(tied[0], tied[1]) else tied[1]
        for node in self._open_path(best):
            self._emit(node)
        return least, "".join(self.audit), self.digest.hexdigest()


class _Conversation:
    """Counts and repair of one conversation whose rows come in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.repair = conv_id, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.distinct, self.initial, self.row = 0, None, None

    def add(self, turn: int | None, role: str, text: bytes, digest: bytes, seen: bool) -> None:
        seen = seen or self.row == (turn, digest)
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        body = text.rstrip(_WHITE)
        blank = not body
        duplicate = seen and not blank
        truncated = not blank and not duplicate and not body.endswith(_ENDS)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.row is not None:
            self.illegal += self.initial + role[:1] not in _LEGAL
        self.initial, self.row = role[:1], (turn, digest)
        self.repair.turn(role, text, blank or duplicate, truncated)

    def result(self) -> dict:
        cost, audit, digest = self.repair.finish()
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.distinct
        return {
            "conv_id": self.conv_id,
            "gaps": gaps if gaps < 2**63 else None,
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "cost": cost,
            "audit": audit,
            "repaired_sha256": digest,
        }


REPAIRED = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
_TYPES = {
    name: pa.string() if kind == "string" else pa.int64() for name, kind in (part.split() for part in REPAIRED.split(", "))
}


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The conversations of a task, whose rows are sorted; each is done when the next one begins."""
    current, done, held = None, [], 0
    for batch in batches:
        for conv_id, turn, role, text, digest, seen, present in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.result())
                    held += len(done[-1]["audit"])
                current = _Conversation(conv_id)
            if present:
                current.add(turn, role, text, digest, seen)
            if len(done) >= 5_000 or held > 2**24:
                yield _batch(done)
                done, held = [], 0
    if current is not None:
        done.append(current.result())
    yield _batch(done)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in _TYPES.items()], list(_TYPES))


def text_or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, present: the rows with faults put in by the crc32 of ``conv_id:turn``, modulo 20.

    0 drops a row (``present`` is false), 1 empties its text, 2 takes its ``.``, ``!`` and ``?`` away, 3 repeats it, 4 gives
    it the role user. NULL stands for one space, in the key, too.
    """
    key = F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn"))
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        text_or_space("role").alias("role"),
        text_or_space("text").alias("text"),
        (F.crc32(key) % 20).alias("fault"),
    )
    fault = F.col("fault")
    text = F.when(fault <= 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault != 0).alias("present"), "fault")
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(times)).drop("fault", "copy")


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    ``turns`` has conv_id, turn, role, text and optionally ``present``; a row that isn't present only names its
    conversation. A conversation's rows are taken by turn, NULL first, then role and text. A row's first fault counts:
    blank, duplicate (a row of the same role and text came before), truncated (its last visible character ends no
    sentence). ``illegal`` counts neighbours whose roles don't begin with su, ua or au; ``gaps`` the turns missing between
    the least and greatest. Edits are K(eep) 0, R(erole) 1, D(elete) 2, I(nsert an empty turn) 5, and 5 more for a truncated
    row that stays; blank and duplicate rows have to go. Among the cheapest, the audit that comes first in ASCII.

    NULL roles and texts are one space; a NULL conv_id is a conversation of its own; repeated rows are duplicates; other
    columns are ignored; a conversation without present rows has zeros and an empty audit; an empty table gives no rows.
    Gaps beyond a long are NULL.

    Rows are shuffled once by conversation; which texts come more than once is found on digests, reduced on the map
    side, and joined only for those that do.
    """
    present = F.col("present") if "present" in turns.columns else F.lit(True)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        text_or_space("role").alias("role"),
        text_or_space("text").cast("binary").alias("text"),
        present.alias("present"),
    )
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string").cast("binary"), F.lit(b":"), F.col("role").cast("binary"), "text")))
    rows = stage(rows.withColumn("digest", digest), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = (
        rows.filter("present")
        .groupBy("conv_id", "digest")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first != last")
        .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    seen = F.coalesce(place > F.col("first"), F.lit(False))
    rows = rows.join(stage(again, "repeated-turns"), same, "left").select(
        "conv_id", "turn", F.col("role"), "text", "digest", seen.alias("seen"), "present"
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text"
    )
    return ordered.mapInArrow(_repaired, REPAIRED)


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The repair of each conversation after ``damaged`` has put faults into it."""
    return repair(damaged(conversations))
