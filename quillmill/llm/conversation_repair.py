"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

The role initials of a repaired conversation read `(s?(ua)+)?`. Every row is kept (0), given another role (3) or
deleted (4); a message without text may be inserted anywhere (3). Blank and duplicate rows have to be deleted; a
truncated row that stays costs 3 more. The audit of a repair is the initials of its edits in order (D, I, K, R). Of
the cheapest repairs the one with the ASCII-least audit is made.

A conversation is a graph of nodes (place, state of the grammar). Costs to the end are found backwards; the arcs on
cheapest paths are kept. Nodes are then ranked by the audits that begin there: first by one edit, then by 2, 4, 8,
..., the rank of twice the length being that of the pair (own rank, rank of the node that many edits on). The ranks
pick an arc for every node, and the path is unrolled from the start through the doubled pointers. A state and an
edit lead to one state only, so no two arcs of a node have the same initial, and nodes point to one node each.

Conversations of up to `segment` rows are repaired whole, many at once, where they are sorted. Longer ones, of any
length, are cut into segments: the costs of crossing a segment from each state to each other are a 4 x 4 table; run
backwards over the tables of a conversation, they give the costs to the end that hold behind every segment, with
which the segments can be repaired apart. Forwards, the state in which one segment ends is that in which the next
begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quillmill.llm.common import salted_join
from quillmill.operators.skew import keyed_join
from quillmill.session import ship
from quillmill.staging import stage, stage_counted

SEGMENT = 4096
"""Rows that a task holds of a conversation."""
SEGMENT_BYTES = 2**24
"""Conversations with more text than this are cut as well."""
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
PRICE = [4, 3, 0, 3]
TRUNCATED = 3
BLANKS = " \t\n\x0b\x0c\r"
# States: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
STATES = 4
NEXT = {"s": [1, -1, -1, -1], "u": [2, 2, -1, 2], "a": [-1, -1, 3, -1], "": [-1] * 4}
INITIALS = ["s", "u", "a", ""]
STEP = np.array([NEXT[i] for i in INITIALS])
WANTED = np.array([2, 2, 3, 2])
"""The state that a message of the role that a state asks for leads to."""
ROLES = ["user", "user", "assistant", "user"]
FAR = 2**40
END = np.array([0, 6, 3, 0])
"""What it costs to end in each state, by inserts."""
ORDINAL = 2**33 - 1


def costs(initial: np.ndarray, gone: np.ndarray, cut: np.ndarray, starts: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Least costs from each (place, state) to the end of its segment, whose places behind have the costs `base`.

    Segment s has the rows starts[s] to starts[s + 1] and one place more than rows, from starts[s] + s on.
    """
    sizes = np.diff(starts)
    cost = np.zeros((len(initial) + len(sizes), STATES), np.int64)
    ends = starts[1:] + np.arange(len(sizes))
    cost[ends] = base
    order = np.argsort(-sizes, kind="stable")
    longer = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes.max(initial=0) + 1), "right")
    for t in range(1, sizes.max(initial=0) + 1):
        some = order[: longer[t - 1]]
        place, row = ends[some] - t, starts[some + 1] - t
        after = cost[place + 1]
        best = after + PRICE[DELETE]
        stays = np.where(gone[row], FAR, np.where(cut[row], TRUNCATED, 0))[:, None]
        to = STEP[initial[row]]
        kept = np.take_along_axis(after, np.maximum(to, 0), 1)
        best = np.minimum(best, np.where(to >= 0, kept + stays, FAR))
        best = np.minimum(best, after[:, WANTED] + stays + PRICE[REROLE])
        best[:, 2], best[:, 3] = np.minimum(best[:, 2], best[:, 3] + PRICE[INSERT]), np.minimum(best[:, 3], best[:, 2] + PRICE[INSERT])
        best[:, :2] = np.minimum(best[:, :2], best[:, 2:3] + PRICE[INSERT])
        cost[place] = best
    return cost


def arcs(initial, gone, cut, starts, cost, last) -> tuple[np.ndarray, np.ndarray]:
    """For each node and edit, in the order of their initials: is the edit on a cheapest path, and the node it leads to.

    Behind the last row of a segment there are no arcs, but for inserts where `last` says that the conversation ends.
    """
    sizes = np.diff(starts)
    n = len(cost)
    place = np.arange(n)
    segment = np.repeat(np.arange(len(sizes)), sizes + 1)
    behind = np.zeros(n, bool)
    behind[starts[1:] + np.arange(len(sizes))] = True
    row = np.where(behind, 0, place - segment)
    row = np.minimum(row, max(0, len(initial) - 1))
    if len(initial):
        to, forced, broken = STEP[initial[row]], gone[row], cut[row]
    else:
        to, forced, broken = np.full((n, STATES), -1), np.ones(n, bool), np.zeros(n, bool)
    stays = np.where(broken, TRUNCATED, 0)[:, None]
    state = np.broadcast_to(np.arange(STATES), (n, STATES))
    here, after = place[:, None], np.minimum(place + 1, n - 1)[:, None]
    row_open = ~behind[:, None]
    choices = [
        (row_open & (state >= 0), after, state, PRICE[DELETE]),
        ((row_open | last[segment][:, None]) & (state >= 0), here, np.broadcast_to(WANTED, (n, STATES)), PRICE[INSERT]),
        (row_open & ~forced[:, None] & (to >= 0), after, np.maximum(to, 0), stays),
        (row_open & ~forced[:, None], after, np.broadcast_to(WANTED, (n, STATES)), stays + PRICE[REROLE]),
    ]
    good, target = np.zeros((n * STATES, 4), bool), np.zeros((n * STATES, 4), np.int64)
    for edit, (may, at, into, price) in enumerate(choices):
        good[:, edit] = (may & (cost == cost[at, into] + price)).ravel()
        target[:, edit] = (at * STATES + into).ravel()
    return good, target


def least_arcs(good: np.ndarray, target: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's arc with the least (initial, rank of its target): the edit, and the target (itself, where a path ends)."""
    value = np.where(good, np.arange(4) * (rank.max(initial=0) + 1) + rank[target], np.iinfo(np.int64).max)
    edit = value.argmin(axis=1)
    ends = ~good.any(axis=1)
    nodes = np.arange(len(good))
    return np.where(ends, -1, edit), np.where(ends, nodes, target[nodes, edit])


def doubled(pointer: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Pointers 1, 2, 4, ... edits on, up to the first that are at the ends of all paths."""
    levels = [pointer]
    while not ends[levels[-1]].all():
        levels.append(levels[-1][levels[-1]])
    return levels


def path_ranks(edit: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Ranks of the nodes by the whole audits that begin there; a path that ends is before one that goes on."""
    rank = edit + 1
    for pointer in levels:
        pair = rank.astype(np.int64) * (int(rank.max(initial=0)) + 1) + rank[pointer]
        rank = np.unique(pair, return_inverse=True)[1]
    return rank


def unrolled(entry: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """Nodes of the paths from the nodes `entry`, one path after the other, without their ends."""
    nodes = entry[~ends[entry]]
    for pointer in reversed(levels):
        pairs = np.stack([nodes, pointer[nodes]], axis=1).ravel()
        fresh = np.ones(len(pairs), bool)
        fresh[1::2] = ~ends[pairs[1::2]]
        nodes = pairs[fresh]
    return nodes


class Plan:
    """Repairs of segments: `initial` (an index of INITIALS), `gone` (has to be deleted) and `cut` (truncated) of their
    rows, the costs behind each segment, and whether it is the last of its conversation."""

    def __init__(self, initial, gone, cut, starts, base, last) -> None:
        self.starts = starts
        self.cost = costs(initial, gone, cut, starts, base)
        good, target = arcs(initial, gone, cut, starts, self.cost, last)
        edit, pointer = least_arcs(good, target, np.zeros(len(good), np.int64))
        self.ends = edit < 0
        rank = path_ranks(edit, doubled(pointer, self.ends))
        self.edit, pointer = least_arcs(good, target, rank)
        self.levels = doubled(pointer, self.ends)

    def entries(self, states: np.ndarray) -> np.ndarray:
        return (self.starts[:-1] + np.arange(len(self.starts) - 1)) * STATES + states

    def exits(self) -> np.ndarray:
        """The state behind each segment, for each state before it."""
        nodes = self.entries(np.zeros(len(self.starts) - 1, np.int64))[:, None] + np.arange(STATES)
        return self.levels[-1][nodes] % STATES

    def edits(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Edits in order: segment, edit, row (that of the next row for inserts) and state before it."""
        nodes = unrolled(self.entries(states), self.levels, self.ends)
        place = nodes // STATES
        segment = np.searchsorted(self.starts[:-1] + np.arange(len(self.starts) - 1), place, "right") - 1
        return segment, self.edit[nodes], place - segment, nodes % STATES


def _initials(roles: list[str]) -> np.ndarray:
    return np.array([INITIALS.index(role[:1]) if role[:1] in ("s", "u", "a") else 3 for role in roles], np.int64)


def _edit_batches(rows: dict[str, list], starts: np.ndarray, plan: Plan, states: np.ndarray, kinds: pa.Schema) -> pa.RecordBatch:
    """The edits of segments with what each is made to."""
    segment, edit, row, state = plan.edits(states)
    step = np.arange(len(segment)) - np.searchsorted(segment, segment)
    out = {name: [] for name in kinds.names}
    for s, k, e, r, q in zip(segment.tolist(), step.tolist(), edit.tolist(), row.tolist(), state.tolist(), strict=True):
        first = int(starts[s])
        added = e == INSERT
        was = None if added else rows["role"][r]
        values = {
            "key": rows["key"][first], "conv_id": rows["conv_id"][first], "segment": rows["segment"][first], "step": k, "edit": EDITS[e],
            "at": None if added else rows["at"][r], "turn": None if added else rows["turn"][r], "fault": None if added else rows["fault"][r],
            "was": was, "role": None if e == DELETE else was if e == KEEP else ROLES[q], "text": "" if added else rows["text"][r],
        }
        for name in out:
            out[name].append(values[name])
    return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in kinds], kinds.names)


def _plan(rows: dict[str, list], starts: np.ndarray, base: np.ndarray, last: np.ndarray) -> Plan:
    fault = np.array([f or "" for f in rows["fault"]], object)
    return Plan(_initials(rows["role"]), np.isin(fault, ["blank", "duplicate"]), fault == "truncated", starts, base, last)


def _repair_sorted(kinds: pa.Schema, size: int):
    """Repairs whole conversations, whose rows come one after the other."""
    names = ["key", "conv_id", "turn", "role", "text", "fault"]

    def repaired(rows: dict[str, list]) -> pa.RecordBatch:
        starts = [0, *(i for i in range(1, len(rows["key"])) if rows["key"][i] != rows["key"][i - 1])]
        bounds = np.array([*starts, len(rows["key"])])
        for first, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            said = set()
            for i in range(first, stop):
                one = (rows["role"][i], rows["text"][i])
                if rows["fault"][i] != "blank" and one in said:
                    rows["fault"][i] = "duplicate"
                said.add(one)
        rows |= {"segment": [0] * len(rows["key"]), "at": [None] * len(rows["key"])}
        n = len(starts)
        plan = _plan(rows, bounds, np.broadcast_to(END, (n, STATES)), np.ones(n, bool))
        return _edit_batches(rows, bounds, plan, np.zeros(n, np.int64), kinds)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {name: [] for name in names}
        for batch in batches:
            for name in names:
                held[name] += batch.column(name).to_pylist()
            # The last conversation may go on in the next batch.
            keys = held["key"]
            done = len(keys)
            while done and keys[done - 1] == keys[-1]:
                done -= 1
            if done >= size:
                yield repaired({name: values[:done] for name, values in held.items()})
                held = {name: values[done:] for name, values in held.items()}
        if held["key"]:
            yield repaired(held)
    return repair


def _crossing(table: pa.Table) -> pa.Table:
    """The costs of crossing one segment, from each state to each."""
    table = table.sort_by("at")
    initial, gone, cut, starts = _narrow(table)
    n = len(STEP)
    crossed = [costs(initial, gone, cut, starts, np.where(np.arange(n) == q, 0, FAR)[None])[0].tolist() for q in range(n)]
    return pa.table({
        "key": table["key"][:1], "segment": table["segment"][:1],
        "crossing": pa.array([[crossed[q][p] for p in range(n) for q in range(n)]], pa.list_(pa.int64()))})


def _narrow(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    fault = np.array([f or "" for f in table["fault"].to_pylist()], object)
    return (_initials(table["role"].to_pylist()), np.isin(fault, ["blank", "duplicate"]), fault == "truncated",
            np.array([0, table.num_rows]))


def _bases(segments: pd.DataFrame) -> pd.DataFrame:
    """Costs to the end behind each segment of one conversation; its tables only, one for many rows."""
    segments = segments.sort_values("segment", ascending=False, ignore_index=True)
    base, out = END, []
    for crossing in segments["crossing"]:
        out.append(base.tolist())
        base = (np.array(crossing).reshape(STATES, STATES) + base).min(axis=1)
    return segments[["key", "segment"]].assign(base=out, last=segments.index == 0)


def _exits(table: pa.Table) -> pa.Table:
    table = table.sort_by("at")
    initial, gone, cut, starts = _narrow(table)
    plan = Plan(initial, gone, cut, starts, np.array([table["base"][0].as_py()]), np.array([table["last"][0].as_py()]))
    return pa.table({
        "key": table["key"][:1], "segment": table["segment"][:1], "base": table["base"][:1], "last": table["last"][:1],
        "exits": pa.array([plan.exits()[0].tolist()], pa.list_(pa.int32()))})


def _entries(segments: pd.DataFrame) -> pd.DataFrame:
    """The state before each segment of one conversation."""
    segments = segments.sort_values("segment", ignore_index=True)
    state, out = 0, []
    for exits in segments["exits"]:
        out.append(state)
        state = int(exits[state])
    return segments[["key", "segment", "base", "last"]].assign(entry=out)


def _repair_segment(kinds: pa.Schema):
    def repair(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        rows = {name: table[name].to_pylist() for name in ("key", "conv_id", "segment", "at", "turn", "role", "fault")}
        rows["text"] = [None] * table.num_rows
        starts = np.array([0, table.num_rows])
        plan = _plan(rows, starts, np.array([table["base"][0].as_py()]), np.array([table["last"][0].as_py()]))
        return pa.Table.from_batches([_edit_batches(rows, starts, plan, np.array([table["entry"][0].as_py()]), kinds)])
    return repair


def conversation_key(conv_id: Column) -> Column:
    """A string that is never null, so that rows without conv_id are a conversation too."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _judged(rows: DataFrame) -> DataFrame:
    """Rows with `key` and the faults that a row has by itself."""
    space = F.lit(" ")
    given = rows.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    return given.select(conversation_key(F.col("conv_id")).alias("key"), "*", fault.alias("fault"))


def _edit_kind(rows: DataFrame) -> str:
    types = dict(rows.dtypes)
    return (f"key string, conv_id {types['conv_id']}, segment long, step long, edit string, at long, turn {types['turn']}, "
            "fault string, was string, role string, text string")


def _arrow_schema(spark: SparkSession, kind: str) -> pa.Schema:
    return to_arrow_schema(spark.createDataFrame([], kind).schema)


def _edits(rows: DataFrame, segment: int, segment_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Edits of the conversations that are repaired whole, each one's rows together and in order, and of the others."""
    spark = ship(rows.sparkSession)
    kind = _edit_kind(rows)
    kinds = _arrow_schema(spark, kind)
    # Numbered before anything is dealt out, so that a task that is run again numbers its rows as before.
    judged = _judged(rows).withColumn("row", F.monotonically_increasing_id())
    counted = judged.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    large = counted.where((F.col("rows") > segment) | (F.col("bytes") > segment_bytes))
    large, number = stage_counted(large.select("key", "rows"), "long_conversations")
    order = ["key", F.asc_nulls_first("turn"), "role", "text"]
    whole = judged
    if number:
        total = judged.count()
        whole = keyed_join(judged, large.select("key"), ["key"], "left_anti", total)
    whole = whole.drop("row").repartition("key").sortWithinPartitions(*order).mapInArrow(_repair_sorted(kinds, segment), kind)
    if not number:
        return whole, None
    rest = keyed_join(judged, large.select("key"), ["key"], "left_semi", total)
    return whole, _edits_in_segments(rest.orderBy(*order, "row"), segment, kind, kinds)


def _edits_in_segments(rows: DataFrame, segment: int, kind: str, kinds: pa.Schema) -> DataFrame:
    # The number has the sorted partition and the place in it; a segment lies within one partition.
    told = stage(rows.drop("row").withColumn("at", F.monotonically_increasing_id()), "long_rows")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    narrow = told.select(
        "key", "conv_id", "turn", "role", "fault", "at", said.alias("said"),
        (F.col("at") - F.pmod(F.col("at").bitwiseAND(ORDINAL), F.lit(segment))).alias("segment"))
    first = narrow.groupBy("key", "said").agg(F.min("at").alias("first"))
    again = F.when(F.coalesce(F.col("fault"), F.lit("")) == "blank", "blank").otherwise(
        F.when(F.col("at") > F.col("first"), "duplicate").otherwise(F.col("fault")))
    narrow = stage(
        salted_join(narrow, first, ["key", "said"], F.col("at")).withColumn("fault", again).drop("said", "first"), "long_faults")
    place = ["key", "segment"]
    crossings = stage(narrow.groupBy(place).applyInArrow(_crossing, "key string, segment long, crossing array<long>"), "crossings")
    bases = stage(crossings.groupBy("key").applyInPandas(_bases, "key string, segment long, base array<long>, last boolean"), "bases")
    exits = stage(narrow.join(bases, place).groupBy(place).applyInArrow(
        _exits, "key string, segment long, base array<long>, last boolean, exits array<int>"), "exits")
    entries = stage(exits.groupBy("key").applyInPandas(
        _entries, "key string, segment long, base array<long>, last boolean, entry int"), "entries")
    edits = stage(narrow.join(entries, place).groupBy(place).applyInArrow(_repair_segment(kinds), kind), "long_edits")
    found = edits.where("edit <> 'I'").drop("text").join(told.select("at", "text"), "at").select(*edits.columns)
    return found.unionByName(edits.where("edit = 'I'"))


def repair_edits(rows: DataFrame, segment: int = SEGMENT, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The edits of every conversation: `conv_id, segment, step, edit, turn, fault, was, role, text`.

    `rows` are messages (`conv_id, turn, role, text`), a conversation's in the order of turn (nulls first), then role
    and text. Edits of a conversation are in order by (segment, step). `edit` is one of K (kept), R (another role), D
    (deleted), I (inserted). The repaired conversation is the role and text of all but the deleted edits, whose role
    is null and whose text is the deleted one. `was` is the role as given, `turn` the turn and `fault` the row's first
    fault (blank, duplicate, truncated or null); all three are null for inserted rows.

    A null role or text counts as one space, a space being no role; roles go by their first letter, in lower case. An
    empty text is blank. Rows without conv_id are one conversation. Repeated rows are duplicates of the first. Empty
    tables give no rows. Other columns are not read.
    """
    whole, cut = _edits(rows, segment, segment_bytes)
    return (whole if cut is None else whole.unionByName(cut)).drop("key", "at")


def repaired_conversations(rows: DataFrame, segment: int = SEGMENT, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """`conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256` of every conversation of `rows`.

    Counts are those of the rows as given: `gaps` the turns missing between the first and the last (0 where all are
    null), `illegal` the neighbours whose initials are not su, ua or au. The hash is that of the repaired messages
    `role:text`, joined by newlines. See `repair_edits` for nulls, ties and repeated rows.
    """
    whole, cut = _edits(rows, segment, segment_bytes)
    kind = (f"conv_id {dict(rows.dtypes)['conv_id']}, gaps long, blank long, duplicate long, truncated long, illegal long, "
            "cost long, audit string, repaired_sha256 string")
    # Hashes run over a conversation from its start to its end, so one task sees each one's edits, as a stream.
    told = whole.mapInArrow(_summed(_arrow_schema(rows.sparkSession, kind)), kind)
    if cut is None:
        return told
    line = cut.repartition("key").sortWithinPartitions("key", "segment", "step")
    return told.unionByName(line.mapInArrow(_summed(_arrow_schema(rows.sparkSession, kind)), kind))


class _Summary:
    """What is known of one conversation, edit by edit."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.cost = self.turns = 0
        self.audit: list[str] = []
        self.digest, self.empty = hashlib.sha256(), True
        self.before = self.least = self.turn = None

    def add(self, edit: str, turn, fault: str | None, was: str | None, role: str | None, text: str) -> None:
        self.audit.append(edit)
        self.cost += PRICE[EDITS.index(edit)] + (TRUNCATED if fault == "truncated" and edit in "KR" else 0)
        if edit != "D":
            self.digest.update((("" if self.empty else "\n") + f"{role}:{text}").encode())
            self.empty = False
        if edit == "I":
            return
        if fault:
            self.faults[fault] += 1
        if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = was[:1]
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.turns
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def _summed(kinds: pa.Schema):
    names = ["edit", "turn", "fault", "was", "role", "text"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for batch in batches:
            done = []
            keys, ids = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            for i, values in enumerate(zip(*(batch.column(name).to_pylist() for name in names), strict=True)):
                if now is None or keys[i] != key:
                    done += [now.row()] if now else []
                    key, now = keys[i], _Summary(ids[i])
                now.add(*values)
            yield _rows(done, kinds)
        yield _rows([now.row()] if now else [], kinds)
    return summed


def _rows(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kinds, strict=True)], kinds.names)
