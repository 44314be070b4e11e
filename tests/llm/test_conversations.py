"""Conversation repair against an exhaustive search and a plain dynamic programme over whole strings."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from llm.helpers import CLASHING, as_rows

from riskmill.llm import conversations as c
from riskmill.llm.common import read

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def faults(rows):
    """(role, text) rows in order -> each row's first fault."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def exhaustive(rows):
    """The cheapest edits of a few rows: every choice of edits, with up to two inserted turns at each place."""
    found, best = faults(rows), None
    inserts = [()] + [(r,) for r in ("user", "assistant")] + list(itertools.product(("user", "assistant"), repeat=2))
    options = []
    for (role, text), fault in zip(rows, found):
        stay = 0 if fault != "truncated" else 5
        choices = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            choices.append((stay, "K", [(role, text)]))
            choices += [(stay + 1, "R", [(to, text)]) for to in ("user", "assistant")]
        options += [[(5 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserts], choices]
    options.append([(5 * len(i), "I" * len(i), [(r, "") for r in i]) for i in inserts])
    for chosen in itertools.product(*options):
        turns = [t for _, _, part in chosen for t in part]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in turns)):
            key = (sum(x for x, _, _ in chosen), "".join(a for _, a, _ in chosen))
            if best is None or key < best[:2]:
                best = (*key, turns)
    return best


def plain(rows):
    """The same with whole strings for each state."""
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(best):
        for _ in range(4):
            for state, (cost, audit, turns) in list(best.items()):
                for initial, after in follow[state].items():
                    if initial in names:
                        offer(best, after, cost + 5, audit + "I", [*turns, (names[initial], "")])
        return best

    def offer(best, state, cost, audit, turns):
        if state not in best or (cost, audit) < best[state][:2]:
            best[state] = (cost, audit, turns)

    best = with_inserts({"": (0, "", [])})
    for (role, text), fault in zip(rows, faults(rows)):
        new, stay = {}, 5 if fault == "truncated" else 0
        for state, (cost, audit, turns) in best.items():
            offer(new, state, cost + 2, audit + "D", turns)
            if fault not in ("blank", "duplicate"):
                for initial, after in follow[state].items():
                    if role[:1] == initial:
                        offer(new, after, cost + stay, audit + "K", [*turns, (role, text)])
                    if initial in names:
                        offer(new, after, cost + stay + 1, audit + "R", [*turns, (names[initial], text)])
        best = with_inserts(new)
    return min(best[s] for s in ("", "a") if s in best)


def repaired(rows):
    repair = c.Repair()
    for (role, text), fault in zip(rows, faults(rows)):
        repair.turn(role, text.encode(), fault in ("blank", "duplicate"), fault == "truncated")
    return repair.finish(), repair.most_open


def digest(turns):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_every_short_conversation(n):
    kinds = [("user", "a."), ("user", "b"), ("assistant", "c!"), ("assistant", "d"), ("system", "e."), ("tool", "f?"), ("", " ")]
    for rows in itertools.product(kinds, repeat=n):
        cost, audit, turns = exhaustive(rows)
        assert plain(rows) == (cost, audit, turns)
        assert repaired(rows)[0] == (cost, audit, digest(turns))


@pytest.mark.parametrize("seed", range(60))
def test_long_conversations(seed):
    r = random.Random(seed)
    roles = [["user", "assistant"], ["user", "assistant", "system", "tool", ""], ["user"], ["assistant", "system"], ["x"]][seed % 5]
    rows = [(r.choice(roles), r.choice(["", f"t{r.randrange(9)}.", f"q{k}?", f"cut {k}"])) for k in range(r.randrange(300))]
    cost, audit, turns = plain(rows)
    assert repaired(rows)[0] == (cost, audit, digest(turns))


def test_open_edits_stay_few():
    rows = [(("user", "assistant")[k % 2], f"{k}.") for k in range(20_000)]
    for k in range(50, 20_000, 97):
        rows[k] = ("user", f"{k}")
    (cost, audit, _), most_open = repaired(rows)
    assert len(audit) >= 20_000 and cost > 0 and most_open < 200


def expected(table):
    """The contract in plain Python for (conv_id, turn, role, text) rows."""
    by_id = {}
    for conv_id, turn, role, text in table:
        rows = by_id.setdefault(conv_id, [])
        fault = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        if fault:
            rows += [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv_id, rows in by_id.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        pairs = [r for _, *r in rows]
        pairs = [tuple(p) for p in pairs]
        kinds = faults(pairs)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(pairs))
        cost, audit, kept = plain(pairs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        yield (conv_id, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest(kept))


def frame(spark, rows):
    schema = f"conv_id long, turn long, role string, text string, {CLASHING}, digest2 string, seen boolean, copy int, fault long"
    return spark.createDataFrame([(*r, *[None] * 20) for r in rows], schema)


def test_the_table(spark, sf_dir):
    table = read(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(c.repair_damaged(table), *COLUMNS) == sorted(expected(rows), key=repr)


def test_awkward_conversations(spark):
    r = random.Random(5)
    rows = [(None, k % 7 if k % 3 else None, "user" if k % 2 else None, f"t{k % 5}.") for k in range(40)]
    rows += [(1, None, None, None), (2, 3, "user", ""), (2, 3, "user", ""), (2, -(2**40), "assistant", "é\u00a0\x1c"), (3, 0, "", "x." * 100_000)]
    rows += [(4, k // 3, r.choice(["user", "assistant", "system", "Ärzte"]), r.choice(["same.", "same.", "ünd", " \t\n", f"{k}!"])) for k in range(400)]
    rows += [(k, 0, "user", "a.") for k in range(100, 160)] + [(5, k, "user", "again.") for k in range(300)]
    got = as_rows(c.repair_damaged(frame(spark, rows).repartition(5)), *COLUMNS)
    assert got == sorted(expected(rows), key=repr)
    assert any(x[7] == "" and x[8] == hashlib.sha256(b"").hexdigest() for x in got)  # dropped as a whole


def test_many_batches_and_no_rows(spark):
    rows = [(7, k, ("user", "assistant")[k % 2], f"{k}.") for k in range(25_000)] + [(8, k, "user", "x") for k in range(50)]
    assert as_rows(c.repair_damaged(frame(spark, rows)), *COLUMNS) == sorted(expected(rows), key=repr)
    assert c.repair_damaged(frame(spark, [])).count() == 0
    assert c.repair(frame(spark, [(1, 0, "user", "a."), (1, 1, "assistant", "b.")])).collect()[0]["audit"] == "KK"
