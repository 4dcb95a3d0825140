"""Passages repeated from earlier documents, by relative Lempel-Ziv factors.

The reference of a document is everything before it (smaller doc_id), held as an index that
is cut by hash into blocks. Every document is factored from left to right against all
blocks: a factor is a longest run of words each of whose `window`-word stretches the
reference has. A run ends where the next stretch is not found; parsing goes on with the
stretches that straddle that boundary, so a factor of another origin may overlap it. Factors
have `window` words or more by construction, and their words are the duplicate spans.

Two things keep the index small. Anchors (the smallest hash among the `GRAM`-word grams of
each window) are indexed first, and stretches are looked up only where their own anchor
occurs in two different texts; equal stretches have equal anchors, so none is lost. And a task
asks only once for each hash of its batch, on behalf of its smallest document: what it has seen
twice it knows already. That bounds what a passage shared by very many documents costs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from quillmill.llm.common import salted_join
from quillmill.llm.words import grams, hash_words, inside, packed_texts, pieces
from quillmill.session import ship
from quillmill.staging import stage

WINDOW = 13
GRAM = 5
BLOCK_BYTES = 2**20
"""Bytes of text for each block of an index; sets the number of blocks."""

_ENTRIES = "block int, owner long, many boolean, hashes binary, owners binary"
_LISTS = pa.list_(pa.binary())
_FACTORS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def anchors(found: np.ndarray, wide: int) -> np.ndarray:
    """For each run of `wide` grams: the smallest hash among them."""
    low, width = found, 1
    while 2 * width <= wide:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return low if width == wide else np.minimum(low[: len(low) - (wide - width)], low[wide - width :])


def _windows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, places of the windows that lie within one text, and the text of each."""
    words, offsets = hash_words(texts)
    at = np.flatnonzero(inside(offsets, window))
    return words, at, np.searchsorted(offsets, at, side="right") - 1


def _anchor_of(words: np.ndarray, at: np.ndarray, window: int, gram: int) -> np.ndarray:
    return anchors(grams(words, gram), window - gram + 1)[at] if len(at) else np.zeros(0, np.uint64)


_NARROW = 6
"""Bytes of an anchor's hash and of its owner; anchors only tell where to look, so few are enough."""
_LOW = np.uint64(2 ** (8 * _NARROW) - 1)


def _packed(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(data: bytes, width: int, kind=np.uint64) -> np.ndarray:
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return wide.view(kind).reshape(-1)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any column."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return out


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(_changes(*columns))
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(columns[0])], strict=True)) if len(cuts) else []


def _ask(hashes: np.ndarray, owners: np.ndarray, blocks: int, both: bool) -> Iterator[pa.RecordBatch]:
    """One entry for each distinct hash, on behalf of its smallest owner, and what is known already.

    `both`: a hash with two owners in here is known for both (else only for the larger ones).
    """
    width = _NARROW if both else 8
    order = np.lexsort((owners, hashes))
    h, o = hashes[order], owners[order]
    fresh = _changes(h, o)
    h, o = h[fresh], o[fresh]
    first = _changes(h)
    many = ~np.append(first, True)[1:][first]  # another owner follows
    known = ~first | ~np.append(first, True)[1:] if both else ~first
    rows = []
    kh, ko = h[known], o[known]
    by = np.argsort(ko, kind="stable")
    kh, ko = kh[by], ko[by]
    rows += [(int(ko[a] % blocks), int(ko[a]), None, _packed(kh[a:b], width), None) for a, b in _runs(ko)]
    h, o = h[first], o[first]
    block = (h % np.uint64(blocks)).astype(np.int32)
    by = np.lexsort((many, block))
    h, o, many, block = h[by], o[by], many[by], block[by]
    rows += [(int(block[a]), None, bool(many[a]), _packed(h[a:b], width), _packed(o[a:b], width)) for a, b in _runs(block, many)]
    if rows:
        kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["block", "owner", "many", "hashes", "owners"])


def _anchor_entries(window: int, gram: int, blocks: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = batch.column("owner").to_numpy()
            for start, texts in pieces(batch):
                words, at, doc = _windows(texts, window)
                found = _anchor_of(words, at, window, gram) & _LOW
                new = _changes(found, doc)  # windows in a row often have the same anchor
                yield from _ask(found[new], owner[start : start + len(texts)][doc[new]], blocks, both=True)
    return entries


def _window_entries(window: int, gram: int, blocks: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner = batch.column("doc_id").to_numpy()
            for start, texts in pieces(batch, packed=True):
                words, at, doc = _windows(texts, window)
                found = _anchor_of(words, at, window, gram) & _LOW
                look = _listed(found, doc, batch.column("shared").slice(start, len(texts)).to_pylist(), _NARROW)
                hashes = grams(words, window)[at[look]]
                yield from _ask(hashes, owner[start : start + len(texts)][doc[look]], blocks, both=False)
    return entries


def _listed(hashes: np.ndarray, doc: np.ndarray, lists: list[list[bytes] | None], width: int) -> np.ndarray:
    """Which hashes are in their own document's list."""
    out = np.zeros(len(hashes), bool)
    cuts = np.searchsorted(doc, np.arange(len(lists) + 1))
    for i, listed in enumerate(lists):
        if listed:
            a, b = cuts[i], cuts[i + 1]
            out[a:b] = np.isin(hashes[a:b], _unpacked(b"".join(listed), width))
    return out


def _answer(both: bool):
    """Merge one block of the index; answers go to the owners, one row for each."""
    width = _NARROW if both else 8

    def answer(table: pa.Table) -> pa.Table:
        known = table.filter(pc.is_valid(table.column("owner")))
        rows = set(zip(known.column("owner").to_pylist(), known.column("hashes").to_pylist(), strict=True))
        asked = table.filter(pc.is_null(table.column("owner")))
        parts = asked.column("hashes").to_pylist()
        h = _unpacked(b"".join(parts), width)
        o = _unpacked(b"".join(asked.column("owners").to_pylist()), width, np.int64)
        many = np.repeat(np.array(asked.column("many").to_pylist(), bool), [len(x) // width for x in parts])
        order = np.lexsort((o, h))
        h, o, many = h[order], o[order], many[order]
        first = _changes(h)
        group = np.cumsum(first) - 1
        later = o > o[first][group]
        if both:  # shared if it has two owners here, or had two in some task's batch
            shared = np.bincount(group, weights=later | many) > 0 if len(h) else np.zeros(0, bool)
            hit = shared[group] & ~many
        else:
            hit = later
        h, o = h[hit], o[hit]
        order = np.lexsort((h, o))
        h, o = h[order], o[order]
        fresh = _changes(h, o)
        h, o = h[fresh], o[fresh]
        rows = [*rows, *((int(o[a]), _packed(h[a:b], width)) for a, b in _runs(o))]
        owners, found = zip(*rows, strict=True) if rows else ((), ())
        return pa.table([pa.array(owners, pa.int64()), pa.array(found, pa.binary())], ["owner", "found"])
    return answer


def _gathered(entries: DataFrame, both: bool) -> DataFrame:
    answers = entries.groupBy("block").applyInArrow(_answer(both), "owner long, found binary")
    return answers.groupBy("owner").agg(F.collect_list("found").alias("found"))


def spans(flags: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Factors as (first word, word after the last): runs of windows found, each `window` words wide."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return [(int(a), int(b) + window - 1) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def _joined(cut: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans that overlap or touch, as one."""
    start = end = None
    for a, b in cut:
        if end is not None and a <= end:
            end = max(end, b)
        else:
            if end is not None:
                yield start, end
            start, end = a, b
    if end is not None:
        yield start, end


def _finished(window: int, digest: bool):
    """Spans and what is left of each document; `found` lists its windows that are repeated."""
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in pieces(batch, packed=True):
                yield _finish(batch.slice(start, len(texts)), texts, window, digest)
    return finish


def _finish(part: pa.RecordBatch, texts: list[bytes], window: int, digest: bool) -> pa.RecordBatch:
    found = part.column("found").to_pylist()
    words, at, doc = _windows([t if f else b"" for t, f in zip(texts, found, strict=True)], window)
    flags = _listed(grams(words, window)[at], doc, found, 8)
    cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i, repeats in enumerate(part.column("repeats").to_pylist()):
        split = texts[i].split()
        if repeats:
            cut = [(0, len(split))] if len(split) >= window else []
        else:
            cut = spans(flags[cuts[i] : cuts[i + 1]], window)
        kept, last = [], 0
        for a, b in _joined(cut):
            kept += split[last:a]
            last = b
        kept += split[last:]
        text = b" ".join(kept)
        out.append((len(split), len(split) - len(kept), [{"start": a, "end": b} for a, b in cut],
                    hashlib.sha256(text).hexdigest() if digest else text.decode()))
    n_words, n_removed, cut, kept = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(cut, _FACTORS), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "n_removed", "spans", "kept"])


_RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"


def _sorted_out(window: int, digest: bool):
    """Finish the documents that share no anchor; the others go on with their text."""
    finish = _finished(window, digest)

    def sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waits = pc.fill_null(pc.greater(pc.list_value_length(batch.column("shared")), 0), False)
            wait, over = batch.filter(waits), batch.filter(pc.invert(waits))
            if wait.num_rows:
                empty = [pa.nulls(wait.num_rows, kind) for kind in (pa.int64(), pa.int64(), _FACTORS, pa.string())]
                columns = [wait.column("doc_id"), *empty, wait.column("text"), wait.column("shared").cast(_LISTS)]
                yield pa.RecordBatch.from_arrays(columns, _WAITING)
            if over.num_rows:
                lists = pa.nulls(over.num_rows, _LISTS)
                ready = [over.column("doc_id"), over.column("text"), over.column("repeats"), lists]
                for done in finish([pa.RecordBatch.from_arrays(ready, ["doc_id", "text", "repeats", "found"])]):
                    empty = [pa.nulls(done.num_rows, kind) for kind in (pa.binary(), _LISTS)]
                    yield pa.RecordBatch.from_arrays([*done.columns, *empty], _WAITING)
    return sort_out


_WAITING = ["doc_id", "n_words", "n_removed", "spans", "kept", "text", "shared"]


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """`doc_id, n_words, n_removed, spans, kept` for every row of `docs`.

    A word is removed if a window over it also starts in a document with a smaller doc_id.
    `spans` are the factors (first word, word after the last; they may overlap); `kept` has the
    other words joined by spaces, or with `digest` the SHA-256 of that. A null text has no words.
    Rows without doc_id have no place in the order: they are compared with nothing and come
    back whole. Rows that share a doc_id are one document as to the order: none is the other's
    reference. Other columns are not looked at; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest_of = F.unhex(F.sha2("text", 256))
    seen = Observation()
    told = stage(read.select("doc_id", digest_of.alias("sum"), F.xxhash64(digest_of).bitwiseAND(F.lit(int(_LOW))).alias("owner"), F.octet_length("text").alias("size"))
                 .observe(seen, F.coalesce(F.sum("size"), F.lit(0)).alias("size")), "texts").where("doc_id IS NOT NULL")
    blocks = max(8, seen.get["size"] // BLOCK_BYTES)
    # of equal texts only the first one is parsed: it is the reference of all the others
    classes = told.groupBy("sum").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    name = F.xxhash64(digest_of).bitwiseAND(F.lit(int(_LOW))).alias("owner")
    asked = read.where("doc_id IS NOT NULL").select(name, "text")
    anchored = _gathered(asked.mapInArrow(_anchor_entries(window, gram, blocks), _ENTRIES), both=True)
    plan = salted_join(told.select("doc_id", "sum", "owner").distinct(), classes, ["sum"], F.col("doc_id"))
    plan = stage(plan.withColumn("repeats", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))).drop("first", "copies"), "plan")
    first = plan.where("NOT repeats").join(anchored, "owner")
    plan = first.select("doc_id", "sum", "repeats", F.col("found").alias("shared")).unionByName(
        plan.where("repeats").select("doc_id", "sum", "repeats"), allowMissingColumns=True)
    kind = StructType([*read.schema.fields[:1], StructField("sum", BinaryType()), StructField("text", BinaryType())])
    packed = read.select("doc_id", digest_of.alias("sum"), "text").mapInArrow(packed_texts, kind)
    met = packed.join(plan, ["doc_id", "sum"], "left")
    met = met.select("doc_id", "text", F.coalesce("repeats", F.lit(False)).alias("repeats"), "shared")
    parsed = stage(met.mapInArrow(_sorted_out(window, digest), _RESULT + ", text binary, shared array<binary>"), "parsed")
    waiting = parsed.where("text IS NOT NULL")
    windows = waiting.select("doc_id", "text", "shared").mapInArrow(_window_entries(window, gram, blocks), _ENTRIES)
    found = _gathered(windows, both=False).withColumnRenamed("owner", "doc_id")
    rest = waiting.select("doc_id", "text", F.lit(False).alias("repeats")).join(found, "doc_id", "left")
    done = parsed.where("text IS NULL").select("doc_id", "n_words", "n_removed", "spans", "kept")
    return done.unionByName(rest.mapInArrow(_finished(window, digest), _RESULT))
