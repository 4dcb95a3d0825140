"""Conversations from reply trees: root-to-leaf paths by self-joins, written in a chat template.

Paths are found by doubling: each round joins the table of (message, ancestor 2^k steps up) with itself, so a thread of
any depth takes as many rounds as its length has binary digits. Then the leaves go the longest steps first: every
message found on a path adds the one 2^k steps above it, from the last table back to the first, and each path is whole.
Only ids travel; texts join once, at the end. Joins are plain ones, whose skewed partitions Spark splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from quillmill.session import ship
from quillmill.staging import stage, stage_counted

OPEN, CLOSE = "### ", " </turn>\n"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

_ESCAPE = regex.compile(r"\\|#(?=#)|(?<=<)/(?=turn>)")
_UNESCAPE = regex.compile(r"\\(.)", regex.DOTALL)
_TURN = regex.compile(r"### ((?:[^\\:]|\\.)*): (.*?) </turn>\n", regex.DOTALL)


def escape(text: str) -> str:
    """`text` with no `##` and no `</turn>` in it: a backslash goes into each, and before each backslash."""
    return _ESCAPE.sub(lambda m: {"\\": "\\\\", "#": "#\\", "/": "\\/"}[m[0]], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], trained: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the code point ranges of the texts of role `trained`."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = f"{OPEN}{escape(role).replace(':', chr(92) + ':')}: "
        body = escape(text)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns again, from the formatted text alone."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def root_to_leaf_paths(nodes: DataFrame) -> DataFrame:
    """`tree, leaf, node, up` for every leaf and every message on its way to the root (`up` steps above).

    `nodes` has tree, node and parent; a parent that is null or missing makes a root. Trees
    are told apart null-safely. A message that is its own ancestor is an error.
    """
    tree = F.struct("tree")  # never null itself, so that null trees join as one
    ids = nodes.select(tree.alias("t"), F.col("node").alias("n"), F.col("parent").alias("p")).where("n IS NOT NULL")
    ids = stage(ids.distinct(), "nodes")
    there = ids.select("t", F.col("n").alias("p"))
    up = ids.where("p IS NOT NULL").join(there, ["t", "p"], "left_semi").select("t", "n", F.col("p").alias("a"))
    inner = up.select("t", F.col("a").alias("n")).distinct()
    leaves = ids.select("t", "n").join(inner, ["t", "n"], "left_anti")
    pointers, left = stage_counted(up.select("t", "n", "a"), "pointers")
    levels, most = [], left
    while left:
        if 2 ** len(levels) > most:
            raise ValueError("a message is its own ancestor")
        levels.append(pointers)
        above = pointers.select("t", F.col("n").alias("a"), F.col("a").alias("next"))
        pointers, left = stage_counted(pointers.join(above, ["t", "a"]).select("t", "n", F.col("next").alias("a")), "pointers")
    rows = leaves.select("t", F.col("n").alias("leaf"), "n", F.lit(0).cast("long").alias("up"))
    for k, level in reversed(list(enumerate(levels))):
        rows = stage(rows, "paths")
        rows = rows.unionByName(rows.join(level, ["t", "n"]).select("t", "leaf", F.col("a").alias("n"), (F.col("up") + F.lit(2**k)).alias("up")))
    return rows.select(F.col("t.tree").alias("tree"), "leaf", F.col("n").alias("node"), "up")


def format_trees(messages: DataFrame, best: int | None = None, trained: str = "assistant") -> DataFrame:
    """`tree, leaf, formatted, loss_spans` for each chosen root-to-leaf path of `messages`.

    `messages` has tree, node, parent, turns (array of role and text) and score. Paths of a tree
    rank by the scores met from the root on, higher first (null last), then by node; with `best`
    only that many are formatted, else all. Null roles and texts count as empty.
    """
    ship(messages.sparkSession)
    paths = root_to_leaf_paths(messages.select("tree", "node", "parent"))
    if best is not None:
        scores = messages.select(F.struct("tree").alias("t"), "node", "score").distinct()
        met = paths.withColumn("t", F.struct("tree")).join(scores, ["t", "node"])
        down = F.array_sort(F.collect_list(F.struct(
            (-F.col("up")).alias("place"), F.coalesce(-F.col("score"), F.lit(float("inf"))).alias("worse"), "node")))
        keys = met.groupBy("tree", "leaf").agg(F.transform(down, lambda x: F.struct(x["worse"], x["node"])).alias("key"))
        chosen = keys.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy("key", "leaf"))).where(F.col("rank") <= best)
        chosen = chosen.select(F.struct("tree").alias("t"), "leaf")
        paths = paths.withColumn("t", F.struct("tree")).join(chosen, ["t", "leaf"], "left_semi").drop("t")
    texts = messages.select(F.struct("tree").alias("t"), "node", "turns")
    met = paths.withColumn("t", F.struct("tree")).join(texts, ["t", "node"])
    whole = met.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("place"), "turns"))).alias("turns"))
    turns = F.flatten(F.transform("turns", lambda x: x["turns"]))
    kinds = dict(whole.dtypes)
    kind = f"tree {kinds['tree']}, leaf {kinds['leaf']}, formatted string, loss_spans array<struct<start:long,end:long>>"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turns([(t["role"] or "", t["text"] or "") for t in one.as_py()], trained) for one in batch.column("turns")]
            spans = [[{"start": a, "end": b} for a, b in spans] for _, spans in made]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("leaf"), pa.array([text for text, _ in made], pa.string()), pa.array(spans, _SPANS)],
                ["tree", "leaf", "formatted", "loss_spans"])

    return whole.select("tree", "leaf", turns.alias("turns")).mapInArrow(write, kind)


def as_threads(conversations: DataFrame) -> DataFrame:
    """Conversations in rows by turn (conv_id, turn, role, text) as trees without branches.

    Rows of the same turn are one message; they come in order of role and text, and a repeated row
    is repeated. Null turns come first. Rows without conv_id are one conversation together. A message scores by the
    characters of its texts. A conversation becomes one output cell, so listing its
    turn numbers in one place is no more than what it ends as.
    """
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.array_sort(F.collect_list(said))
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63)))
    nodes = conversations.groupBy(F.col("conv_id").alias("tree"), turn.alias("node")).agg(turns.alias("turns"))
    score = F.aggregate("turns", F.lit(0.0), lambda total, one: total + F.length(one["text"]))
    before = F.lag("node").over(Window.partitionBy("tree").orderBy("node"))
    return nodes.select("tree", "node", before.alias("parent"), "turns", score.alias("score"))


def read_back(formatted: DataFrame) -> DataFrame:
    """`tree` and what its formatted text and loss mask hold, as counts and SHA-256 digests."""
    kind = f"tree {dict(formatted.dtypes)['tree']}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                turns = parse_turns(text)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                said = "".join(f"{role}\n{one}\n" for role, one in turns)
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("tree", "formatted", "loss_spans").mapInArrow(read, kind)
