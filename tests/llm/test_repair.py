"""Repairs of conversations, against all cheapest edits found forwards in plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from quillmill.llm import conversation_repair as repair
from quillmill.llm.conversation_repair import repair_edits, repaired_conversations
from quillmill.llm.queries import op12_conversation_repair

KIND = "conv_id long, turn long, role string, text string, key string, fault int"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def fault_of(role, text, said):
    bare = text.strip(" \t\n\x0b\x0c\r")
    if not bare:
        return "blank"
    if (role, text) in said:
        return "duplicate"
    return None if bare[-1] in ".!?" else "truncated"


def inserted(best):
    for _ in range(3):
        for state, (cost, audit, out) in list(best.items()):
            for role in ("user", "assistant"):
                to = NEXT.get((state, role[0]))
                if to is not None:
                    offer(best, to, (cost + 3, audit + "I", [*out, (role, "")]))
    return best


def offer(best, state, found):
    if state not in best or found[:2] < best[state][:2]:
        best[state] = found


def model(rows):
    """Everything that the operator says of one conversation's rows, which are in order."""
    said, faults = set(), []
    for _, role, text in rows:
        faults.append(fault_of(role, text, said))
        said.add((role, text))
    best = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, audit, out) in best.items():
            offer(after, state, (cost + 4, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                late = 3 if fault else 0
                if (state, role[:1]) in NEXT:
                    offer(after, NEXT[state, role[:1]], (cost + late, audit + "K", [*out, (role, text)]))
                for other in ("user", "assistant"):
                    if (state, other[0]) in NEXT:
                        offer(after, NEXT[state, other[0]], (cost + 3 + late, audit + "R", [*out, (other, text)]))
        best = inserted(after)
    cost, audit, out = min((best[s] for s in ("", "a") if s in best), key=lambda found: found[:2])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    counts = tuple(faults.count(name) for name in ("blank", "duplicate", "truncated"))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def ordered(rows):
    return sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))


def some_rows(seed=3, conversations=60):
    pick = random.Random(seed)
    texts = ["One.", "Two!", "cut", "", " \t", "Why?", "done. \n", "é", "x.y"]
    rows = []
    for conv in range(conversations):
        for turn in range(pick.randint(1, 12)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", ""])
            rows.append((conv, None if pick.random() < 0.05 else turn * pick.choice([1, 1, 2]), role, pick.choice(texts) + pick.choice(["", f" {turn}."])))
    rows += [(None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Yes."), (900, 5, None, None), (901, None, None, "x")]
    return rows + rows[:4] * 2


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], KIND).repartition(4)


def grouped(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def found(df):
    return {row.conv_id: tuple(row)[1:] for row in df.collect()}


@pytest.mark.parametrize("segment", [4096, 3, 1])
def test_against_plain_python(spark, segment):
    rows = some_rows()
    got = found(repaired_conversations(table(spark, rows), segment))
    assert got == {conv: model(ordered(some)) for conv, some in grouped(rows).items()}


def test_conversations_with_much_text_are_cut(spark):
    rows = some_rows(5, 8) + [(7, 99, "user", "long " * 50 + ".")]
    got = found(repaired_conversations(table(spark, rows), 4, 60))
    assert got == {conv: model(ordered(some)) for conv, some in grouped(rows).items()}


def test_one_conversation_has_most_rows(spark):
    pick = random.Random(1)
    rows = [(1, i, pick.choice(["user", "assistant", "system"]), f"t{i % 700}" + pick.choice([".", ""])) for i in range(2000)]
    rows += [(1, 5000, "user", "same.")] * 300 + [(c, 0, "user", "q?") for c in range(2, 40)]
    got = found(repaired_conversations(table(spark, rows), 100))
    assert got == {conv: model(ordered(some)) for conv, some in grouped(rows).items()}


@pytest.mark.parametrize("segment", [4096, 2])
def test_edits(spark, segment):
    rows = [(1, 0, "system", "Be."), (1, 1, "assistant", "A."), (1, 2, "tool", "B."), (1, 3, "user", ""), (1, 4, "user", "end")]
    edits = sorted((r.segment, r.step, r.edit, r.turn, r.fault, r.was, r.role, r.text) for r in repair_edits(table(spark, rows), segment).collect())
    made = [e[2:] for e in edits]
    assert "".join(e[0] for e in made) == model(ordered([r[1:] for r in rows]))[6]
    assert [e for e in made if e[0] != "I"] == [
        (e[0], t, f, r, e[4], x) for e, (_, t, r, x), f in zip((e for e in made if e[0] != "I"), rows, [None, None, None, "blank", "truncated"])]
    out = "".join(e[4][0] for e in made if e[0] != "D")
    assert out.removeprefix("s") in ("ua" * n for n in range(5))


def test_empty_table(spark):
    assert repaired_conversations(table(spark, [])).collect() == []
    assert repair_edits(table(spark, [])).collect() == []


def test_ranks_are_those_of_the_audits():
    pick = np.random.default_rng(3)
    n = 40
    initial, gone, cut = pick.integers(0, 4, n), pick.random(n) < 0.2, pick.random(n) < 0.3
    starts = np.array([0, 7, 7, 20, 40])
    segments = len(starts) - 1
    plan = repair.Plan(initial, gone, cut, starts, np.tile(repair.END, (segments, 1)), np.ones(segments, bool))
    good, target = repair.arcs(initial, gone, cut, starts, plan.cost, np.ones(segments, bool))
    rank = repair.path_ranks(plan.edit, plan.levels)

    def least(node):
        audits = [repair.EDITS[e] + least(target[node, e]) for e in range(4) if good[node, e]]
        return min(audits, default="")

    audits = [least(node) for node in range(len(good))]
    places = sorted(set(audits))
    assert rank.tolist() == [places.index(audit) for audit in audits]


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(place.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        some = out.setdefault(conv, [])
        text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text
        some += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def test_query(spark, tmp_path):
    gone = next(conv for conv in range(1000, 2000) if zlib.crc32(f"{conv}:0".encode()) % 20 == 0)
    rows = some_rows(8, 150) + [(gone, 0, "user", "Dropped.")]
    table(spark, rows).drop("key", "fault").write.parquet(f"{tmp_path}/conversations.parquet")
    want = {conv: model(ordered(some)) for conv, some in damaged(rows).items()}
    assert damaged(rows)[gone] == []
    assert found(op12_conversation_repair(spark, str(tmp_path))) == want
