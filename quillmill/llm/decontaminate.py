"""Benchmark decontamination: passages of test items found in documents by an Aho-Corasick automaton.

Texts are normalised to words: A-Z in lower case, words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. An item's
windows are its runs of `n` consecutive words; an item of fewer words, but not none, is one window. The words of
the windows are numbered, and the automaton runs over these numbers: a document is scanned once, whatever the
number of items, and every occurrence is mapped back to the characters of the text as it was given.

Only the items are sent to the tasks, in shards of at most about `shard_bytes` of text. Items of any number are
dealt into as many shards as they need, documents are scanned once for each shard, and what is found is merged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillmill.session import ship
from quillmill.staging import stage

WINDOW = 10
SHARD_BYTES = 2**20
"""Item text that one automaton holds; some hundred times as many bytes in a task."""
PIECE_WORDS = 1000
"""Longer items are cut, with an overlap of a window less one word, so no shard holds a long text alone."""
PIECE_BYTES = 2**20
"""Documents are scanned in pieces of about this size."""
# In UTF-8 the bytes above 0x7F are never part of an ASCII character, so bytes do for characters.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOUND = "n_words long, spans array<struct<first: long, last: long, start: long, stop: long>>, items array<string>"
TEXTS = "the text of the scan"


class _Numbers(dict):
    """Numbers of the words of all windows; 0 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Automaton:
    """Windows of (item, words) pieces, and the items that each window is part of."""

    def __init__(self, pieces: list[tuple[str | None, list[bytes]]], n: int) -> None:
        self.numbers = _Numbers()
        self.items: list[set[str]] = []
        self.lengths: list[int] = []
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        places: dict[tuple[int, ...], int] = {}
        for item, words in pieces:
            row = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in words]
            for i in range(max(1, len(row) - n + 1)):
                window = tuple(row[i : i + n])
                at = places.setdefault(window, len(places))
                if at == len(self.items):
                    self.items.append(set())
                    self.lengths.append(len(window))
                    self.machine.add_word(window, at)
                if item is not None:
                    self.items[at].add(item)
        self.reach = max(self.lengths, default=1) - 1
        if places:
            self.machine.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, merged runs of hit words (first, last) and the windows that occur."""
        total, tail, runs, seen = 0, (), [], set()
        for piece in _pieces(text.lower()):
            words = WORD.findall(piece)
            row = (*tail, *map(self.numbers.__getitem__, words))
            before = total - len(tail)
            total += len(words)
            if any(row) and self.lengths:
                for last, window in self.machine.iter(row):
                    if last < len(tail):  # found with the piece before
                        continue
                    seen.add(window)
                    first, last = before + last - self.lengths[window] + 1, before + last
                    # Windows end in order, so a run can only grow at its end, or swallow the runs before it.
                    while runs and first <= runs[-1][1] + 1:
                        first = min(first, runs.pop()[0])
                    runs.append((first, last))
            tail = row[-self.reach :] if self.reach else ()
        return total, runs, seen


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text cut between words, so that memory does not follow the longest text's words."""
    start = 0
    while len(text) - start > PIECE_BYTES:
        word = WORD.match(text, start + PIECE_BYTES)
        stop = word.end() if word else start + PIECE_BYTES
        yield text[start:stop]
        start = stop
    yield text[start:]


def spans_of(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of words with the characters [start, stop) of the given text that they cover."""
    if not runs:
        return []
    wanted = iter([edge for run in runs for edge in run])
    next_edge = next(wanted)
    edges, lowered = [], text.lower()
    for at, word in enumerate(WORD.finditer(lowered)):
        while at == next_edge:
            edges.append(word.span())
            next_edge = next(wanted, None)
        if next_edge is None:
            break
    # Every byte that does not continue a character starts one.
    data = np.frombuffer(text, np.uint8)
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [
        {"first": first, "last": last, "start": int(before[edges[2 * i][0]]), "stop": int(before[edges[2 * i + 1][1]])}
        for i, (first, last) in enumerate(runs)
    ]


def benchmark_pieces(benchmark: DataFrame, texts: list[str], n: int = WINDOW) -> DataFrame:
    """`item_id, words`: the words of every item text, joined by spaces, in pieces that overlap by n - 1 words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_pylist()
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                words = WORD.findall((text.as_py() or b"").lower())
                made = [b" ".join(words[at : at + PIECE_WORDS + n - 1]) for at in range(0, max(1, len(words) - n + 1), PIECE_WORDS)]
                made = [one for one in made if one]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i]] * len(made), pa.string()), pa.array(made, pa.binary())], ["item_id", "words"])

    kept = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.array(*[F.col(f"`{t}`") for t in texts]).alias("t"))
    return kept.select("item_id", F.explode("t").alias("text")).mapInArrow(cut, "item_id string, words binary")


_built: dict[tuple[str, int], Automaton] = {}


def _automaton(sent, n: int, key: tuple[str, int]) -> Automaton:
    """The shard's automaton, built once in a worker that runs many tasks; only one is held."""
    if key not in _built:
        _built.clear()
        _built[key] = Automaton([(item, words.split(b" ")) for item, words in sent.value], n)
    return _built[key]


def _scan(sent, n: int, key: tuple[str, int]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(sent, n, key)
        kinds = [pa.int64(), pa.list_(pa.struct([(f, pa.int64()) for f in ("first", "last", "start", "stop")])), pa.list_(pa.string())]
        for batch in batches:
            out = []
            for text in batch.column(TEXTS).cast(pa.binary()):
                text = text.as_py() or b""
                words, runs, seen = automaton.scan(text)
                items = set().union(*(automaton.items[window] for window in seen))
                out.append((words, spans_of(text, runs), sorted(items)))
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != TEXTS]
            names = [name for name in batch.schema.names if name != TEXTS]
            made = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*names, "n_words", "spans", "items"])
    return scan


def find_items(
    docs: DataFrame, benchmark: DataFrame, texts: list[str] | None = None, n: int = WINDOW, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """`doc_id, n_words, spans, items` of every document: what it shares with the items of `benchmark`.

    `texts` names the columns of `benchmark` that hold texts, such as question and answer (default: `text`); each
    is a text of its own. `spans` are the maximal runs of hit words, in order: number of the first and of the last
    word (from 0) and the characters [start, stop) of the text as given. `items` are the ids, as strings and
    sorted as such, of the items with a window in the document.

    A null or empty text has no words, so no span. Rows of `docs` that repeat a doc_id, or have none, are judged
    each on its own. Items that repeat an id count once, with the windows of all their texts; a window that many
    items have counts for each. Items without id mark spans, but are not listed. Items or columns without words
    have no window. Without items, or without documents, nothing is hit. Other columns are not read.
    """
    spark = ship(docs.sparkSession)
    pieces = stage(benchmark_pieces(benchmark, texts or ["text"], n).distinct(), "benchmark_pieces")
    size = pieces.agg(F.sum(F.length("words") + 64)).first()[0] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)))

    def scanned(rows: DataFrame, shard: int) -> DataFrame:
        held = pieces.where(F.col("shard") == shard).select("item_id", "words").toArrow()
        sent = spark.sparkContext.broadcast(list(zip(held["item_id"].to_pylist(), held["words"].to_pylist(), strict=True)))
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != TEXTS)
        return rows.mapInArrow(_scan(sent, n, (spark.sparkContext.applicationId, sent._jbroadcast.id())), f"{kind}, {FOUND}")

    told = docs.select("doc_id", F.col("text").alias(TEXTS))
    if shards == 1:
        return scanned(told, 0)
    told = stage(told.withColumn("row", F.monotonically_increasing_id()), "documents")
    found = None
    for shard in range(shards):
        rows = scanned(told, shard)
        # The first shard tells the words of every document, the others only what they hit.
        rows = stage(rows if shard == 0 else rows.where(F.size("spans") > 0), "found")
        found = rows if found is None else found.unionByName(rows)
    merged = found.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.select("doc_id", "n_words", merged_spans(F.col("spans")).alias("spans"), "items")


def merged_spans(spans: Column) -> Column:
    """Spans of several shards in order, those that touch or overlap joined."""
    kind = "array<struct<first: long, last: long, start: long, stop: long>>"

    def joined(done: Column, one: Column) -> Column:
        end = F.element_at(done, -1)
        longer = F.struct(
            end["first"].alias("first"), F.greatest(end["last"], one["last"]).alias("last"),
            end["start"].alias("start"), F.greatest(end["stop"], one["stop"]).alias("stop"))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        touches = (F.size(done) > 0) & (one["first"] <= F.try_element_at(done, F.lit(-1))["last"] + 1)
        return F.when(touches, grown).otherwise(F.concat(done, F.array(one))).cast(kind)

    return F.aggregate(F.array_sort(spans), F.array().cast(kind), joined)


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1)


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without its spans."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["stop"]))
    starts = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    return F.array_join(F.transform(
        F.arrays_zip(ends.alias("from"), starts.alias("to")),
        lambda gap: F.substring(text, (gap["from"] + 1).cast("int"), (gap["to"] - gap["from"]).cast("int"))), "")
