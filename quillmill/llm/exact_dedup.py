"""Exact duplicates through counting quotient filters and byte verification.

Every task turns the 64-bit fingerprints of its texts into one counting quotient filter, cut
by leading bits into blocks that travel on their own: a fingerprint's quotient is stored as a
position in a bitmap, only its remainder as a value, and copies as a counter. The filters of
all tasks merge block by block, in order of the remainders, without loss. Fingerprints with a
count above one send their documents to verification, which groups by the text itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillmill.llm.common import salted_join
from quillmill.session import ship
from quillmill.staging import stage_counted

BLOCK_FINGERPRINTS = 4096
"""Fingerprints a block of the merged filter has on average; sets the number of blocks."""


def pack_filter(fingerprints: np.ndarray, counts: np.ndarray, quotient_bits: int) -> bytes:
    """A filter block from fingerprints that are sorted, distinct and without their block's bits.

    The values are those below the block's bits, moved to the top. Layout: number of values and
    quotient bits; bitmap of the quotients in use; bitmap of run ends; remainders; indexes and
    counters of the values that occur more than once.
    """
    rest = np.uint64(64 - quotient_bits)
    quotients = (fingerprints >> rest).astype(np.int64) if quotient_bits else np.zeros(len(fingerprints), np.int64)
    used = np.zeros(1 << quotient_bits, bool)
    used[quotients] = True
    ends = np.append(quotients[1:] != quotients[:-1], True)
    width = -(-int(rest) // 8)
    remainders = fingerprints & np.uint64((1 << int(rest)) - 1)
    many = np.flatnonzero(counts > 1)
    return b"".join([
        np.array([len(fingerprints), quotient_bits, len(many)], "<u4").tobytes(),
        np.packbits(used).tobytes(), np.packbits(ends).tobytes(),
        remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes(),
        many.astype("<u4").tobytes(), counts[many].astype("<u8").tobytes(),
    ])


def unpack_filter(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and counts of a block, as `pack_filter` was given them."""
    n, bits, repeated = (int(x) for x in np.frombuffer(block, "<u4", 3))
    rest, at = 64 - bits, 12

    def take(dtype: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(block, dtype, count, at)
        at += out.nbytes
        return out

    used = np.flatnonzero(np.unpackbits(take("u1", -(-(1 << bits) // 8)), count=1 << bits))
    ends = np.unpackbits(take("u1", -(-n // 8)), count=n).astype(np.int64)
    run = np.cumsum(ends) - ends
    width = -(-rest // 8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = take("u1", n * width).reshape(n, width)
    values = wide.view("<u8").reshape(-1).astype(np.uint64)
    if bits:
        values = values | (used[run].astype(np.uint64) << np.uint64(rest))
    counts = np.ones(n, np.uint64)
    many = take("<u4", repeated)
    counts[many] = take("<u8", repeated)
    return values, counts


def merge_filters(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Merge blocks of the same place: runs meet in order of quotient and remainder, counts add up."""
    parts = [unpack_filter(block) for block in blocks]
    values = np.concatenate([values for values, _ in parts])
    counts = np.concatenate([counts for _, counts in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.add.reduceat(counts, first)


def _build(block_bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [batch.column(0).to_numpy() for batch in batches if batch.num_rows]
        if not seen:
            return
        values, counts = np.unique(np.concatenate(seen).view(np.uint64), return_counts=True)
        places = (values >> np.uint64(64 - block_bits)).astype(np.int64) if block_bits else np.zeros(len(values), np.int64)
        cuts = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        blocks = []
        for start, stop in zip(cuts, [*cuts[1:], len(values)], strict=True):
            bits = max(0, min(20, int(math.log2(stop - start))))
            blocks.append(pack_filter(values[start:stop] << np.uint64(block_bits), counts[start:stop], bits))
        yield pa.RecordBatch.from_arrays([pa.array(places[cuts], pa.int64()), pa.array(blocks, pa.binary())], ["place", "filter"])
    return build


def _repeated(block_bits: int):
    def repeated(table: pa.Table) -> pa.Table:
        values, counts = merge_filters(table.column("filter").to_pylist())
        values = values[counts > 1] >> np.uint64(block_bits)
        if block_bits:
            values = values | (np.uint64(table.column("place")[0].as_py()) << np.uint64(64 - block_bits))
        return pa.table({"fingerprint": pa.array(values.view(np.int64), pa.int64())})
    return repeated


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256` for every row of `docs`.

    Texts are equal when their bytes are; a null text counts as empty, so null and empty texts
    are one group. Of equal texts the row with the largest doc_id stays; rows repeating both
    are all marked kept (`keep_documents` leaves one). A row without doc_id stays only where no
    equal text has one; keep_id is then null. Other columns of `docs` are not looked at; an empty table gives an
    empty result. Hot groups: copies collapse in each task's filter and in the partial
    aggregation, and joins are salted, so no task gets a whole group.
    """
    ship(docs.sparkSession)
    text = F.coalesce("text", F.lit("")).alias("text")
    read = docs.select("doc_id", text)
    told = read.select("doc_id", F.xxhash64("text").alias("fingerprint"), F.sha2("text", 256).alias("text_sha256"))
    told, rows = stage_counted(told, "fingerprints")
    block_bits = max(0, math.ceil(math.log2(max(1, rows) / BLOCK_FINGERPRINTS)))
    repeated = (
        told.select("fingerprint").mapInArrow(_build(block_bits), "place long, filter binary")
        .groupBy("place").applyInArrow(_repeated(block_bits), "fingerprint long")
    )
    suspects = salted_join(
        read.withColumn("fingerprint", F.xxhash64("text")), repeated, ["fingerprint"], F.col("doc_id"), "left_semi")
    verified = (
        suspects.groupBy("fingerprint", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size", F.lit(True).alias("copied"))
    )
    met = salted_join(told, verified, ["fingerprint", "text_sha256"], F.col("doc_id"))
    keep_id = F.when(F.col("copied"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return met.select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256")


def keep_documents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of `docs` that `exact_duplicates` keeps, with all their columns, one of each group."""
    from pyspark.sql import Window

    mine, theirs, place = "id of the decision", "sum of the decision", "place in the group"
    kept = decisions.where("kept").select(F.col("doc_id").alias(mine), F.col("text_sha256").alias(theirs))
    digest = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    same = docs["doc_id"].eqNullSafe(F.col(mine)) & (digest == F.col(theirs))
    left = docs.join(kept.distinct(), same, "left_semi")
    others = [F.col(f"`{c}`").cast("string") for c in docs.columns if c not in ("doc_id", "text")]
    one = Window.partitionBy("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)).orderBy(*others, F.lit(0))
    return left.withColumn(place, F.row_number().over(one)).where(F.col(place) == 1).drop(place)
