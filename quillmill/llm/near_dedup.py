"""Near duplicates by MinHash with one permutation, densified, banded and linked by stars.

A document's shingles are hashed once. Of each bin of hash values the smallest is kept (one
permutation instead of many); an empty bin copies the bin that a fixed hash function of its
number and the attempt names first among the filled ones (optimal densification). Bands of bins make bucket
keys. In each bucket all documents are compared with one, the centre of a star, so pairs
grow with the documents. Every candidate is confirmed on the full shingle sets.

Stars alone would miss a link between two documents neither of which is like their centre.
After the stars each bucket therefore looks at what they left apart: documents outside its
largest component are compared with those of other components. Buckets too large for that get
longer keys first (more bins in a band, and more bands, so that links stay as certain).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillmill.llm.common import connected_components, salted_join
from quillmill.llm.words import grams, hash_words, mix, pieces
from quillmill.session import ship
from quillmill.staging import stage, stage_counted

SHINGLE = 5
PERCENT = 85
BANDS = 32
LEVELS = 3
BUCKET_LIMIT = 1000
"""Documents in a bucket above which its key is made longer (`LEVELS` times at most)."""
SETS_AT_ONCE = 256
"""Sets that get longer keys at a time."""
LISTED_IDS = 4_000_000
"""Ids of candidates that are sent to all tasks, to pick their texts; more of them meet the texts in a shuffle."""
_SURE = 1e-6
_LANES, _BITS = 192, 4
_PARITIES = 512
_COPY = np.uint64(0xA0761D6478BD642F)


def band_shape(percent: int, level: int) -> tuple[int, int]:
    """(bands, bins in a band): the longest bands that lose a link at the limit with `_SURE` at most."""
    bands = BANDS * 4**level
    rows = 1
    while (1 - (percent / 100) ** (rows + 1)) ** bands <= _SURE:
        rows += 1
    return bands, rows


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words, one for all of them."""
    words, offsets = hash_words([text.lower() for text in texts])
    found = grams(words, size)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        n = b - a
        sets.append(np.unique(found[a : b - size + 1]) if n >= size else grams(words[a:b], int(n)) if n else np.zeros(0, np.uint64))
    return sets


def one_permutation(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Densified signatures, one row for each (not empty) set of sorted hashes."""
    out = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for i, one in enumerate(sets):
        place = ((one >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        out[i, place[first]] = one[first]
        filled[i, place[first]] = True
    row, bin_ = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        source = (mix(bin_.astype(np.uint64) + np.array([attempt], np.uint64) * _COPY) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
        source = source.astype(np.int64)
        hit = filled[row, source]
        out[row[hit], bin_[hit]] = out[row[hit], source[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return out


def odd_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, whether an odd number of its hashes falls into each of `_PARITIES` places (as bits).

    Members that two sets share cancel out, so their sketches differ in no more places than the sets
    differ in members.
    """
    odd = np.array([np.bincount(one.astype(np.int64) & (_PARITIES - 1), minlength=_PARITIES) & 1 for one in sets], np.uint8)
    return np.packbits(odd.reshape(len(sets), _PARITIES), axis=1).view(np.int64)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit bucket key for each band."""
    lanes = signatures[:, : bands * rows].reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), lanes.shape[:2])
    for k in range(rows):
        key = mix(key ^ lanes[:, :, k])
    return key.view(np.int64)


def _sketches(size: int, bands: int, rows: int):
    bins = max(_LANES, bands * rows)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in pieces(batch):
                sets = shingle_sets(texts, size)
                some = [one for one in sets if len(one)]
                made = one_permutation(some, bins)
                keys = band_keys(made, bands, rows)
                bits = [np.packbits((made[:, :_LANES] >> np.uint64(3 + 6 * k)).astype(np.uint8) & 1, axis=1) for k in range(_BITS)]
                lanes = np.concatenate(bits, axis=1).view(np.int64)
                odd = odd_sketches(some)
                where = np.cumsum([len(one) > 0 for one in sets]) - 1
                full = [len(one) > 0 for one in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, len(texts)),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array(map(_named, sets), pa.binary()),
                    pa.array([lanes[w].tolist() if f else None for w, f in zip(where, full, strict=True)], pa.list_(pa.int64())),
                    pa.array([odd[w].tolist() if f else None for w, f in zip(where, full, strict=True)], pa.list_(pa.int64())),
                    pa.array([keys[w] if f else None for w, f in zip(where, full, strict=True)], pa.list_(pa.int64())),
                ], ["doc_id", "n_shingles", "same", "lanes", "odd", "keys"])
    return sketch


def _named(one: np.ndarray) -> bytes | None:
    """What equal sets have in common and no others; null for empty ones."""
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None


def _sets(size: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch):
                sets = shingle_sets(texts, size)
                yield pa.RecordBatch.from_arrays([
                    pa.array(map(_named, sets), pa.binary()), pa.array([one.view(np.int64) for one in sets], pa.list_(pa.int64()))],
                    ["same", "shingles"])
    return gather


def _longer(bands: int, rows: int):
    def longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SETS_AT_ONCE):
                batch = whole.slice(start, SETS_AT_ONCE)
                sets = [np.array(one, np.int64).view(np.uint64) for one in batch.column("shingles").to_numpy(zero_copy_only=False)]
                keys = band_keys(one_permutation(sets, bands * rows), bands, rows)
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(list(keys), pa.list_(pa.int64()))], ["rep", "keys"])
    return longer


def _differing(sketch: str, longs: int) -> Column:
    return reduce(Column.__add__, [F.bit_count(F.col(f"{sketch}_a")[k].bitwiseXOR(F.col(f"{sketch}_b")[k])) for k in range(longs)])


def _plausible(percent: int) -> Column:
    """Sizes and sketches of two documents (n_a, lanes_a, odd_a, n_b, lanes_b, odd_b) allow that they are alike.

    Sets of sizes that are alike differ in at most `(n_a + n_b) * (1 - limit) / (1 + limit)` members, and
    in no fewer than their odd sketches do; this bound is exact, but says little of large sets.
    For these, at the limit `(1 - limit)` of all lanes differ and so does half of their bits. Both counts
    scatter, more so for small sets, where one shingle fills many lanes; pairs beyond six standard
    deviations are ruled out. All others are compared in full.
    """
    miss = 1 - percent / 100
    n = F.least("n_a", "n_b").cast("double")
    lanes = _LANES * miss * (1 - miss) * (_BITS / 2) ** 2  # how many lanes differ
    coins = F.lit((_LANES / 2) ** 2 * _BITS) * (n * 1.2 * miss + 1) / (n * n)  # which of their bits do
    most = F.lit(_LANES * _BITS * miss / 2) + F.sqrt(coins + F.lit(lanes)) * 6
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    members = _differing("odd", _PARITIES // 64) * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    return sizes & members & (_differing("lanes", _LANES * _BITS // 64) <= most)


def _side(told: DataFrame, x: str) -> DataFrame:
    return told.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("lanes").alias(f"lanes_{x}"),
                       F.col("odd").alias(f"odd_{x}"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose full sets are alike.

    Both joins are plain shuffle joins, whose skewed partitions Spark splits: sets are too wide to be
    repeated for every salt.
    """
    full = pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b")), "b")
    full = full.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a")), "a")
    met = F.size(F.array_intersect("set_a", "set_b"))
    return full.where(met * 100 >= (F.col("n_a") + F.col("n_b") - met) * percent).select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `docs`.

    Documents are linked if their shingle sets share `percent` of their union or more; a component
    is all that links connect, and its smallest doc_id names it. Words are lower-cased (A-Z).
    A document without words links with nothing. Equal sets are one class from the start, which
    is compared once. A row without doc_id links with nothing, is its own component (null) and is
    kept. Rows with words that share a doc_id are one document: what any of them links with is one
    component, in whatever order they come, and each row is given.
    Other columns are not looked at; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    bands, rows = band_shape(percent, 0)
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = "doc_id long, n_shingles long, same binary, lanes array<long>, odd array<long>, keys array<long>"
    told = stage(read.mapInArrow(_sketches(size, bands, rows), kind), "sketches")
    linked = told.where("doc_id IS NOT NULL AND same IS NOT NULL")
    first = [F.first(name).alias(name) for name in ("n_shingles", "lanes", "odd", "keys")]
    classes = linked.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), *first)
    reps = stage(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    classes = reps.select("same", "rep", "doc_id", "copies")

    members = reps.select("rep", F.explode("keys").alias("bucket"))
    crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("centre")).where("members > 1")
    met = stage(salted_join(members, crowded, ["bucket"], F.col("rep"), "inner"), "members")
    told_reps, number = stage_counted(reps.join(met.select("rep").distinct(), "rep", "left_semi").select(
        "rep", "doc_id", "same", "n_shingles", "lanes", "odd"), "candidates")
    ids = told_reps.select("doc_id").distinct()
    texts = read.join(F.broadcast(ids) if number <= LISTED_IDS else ids, "doc_id", "left_semi").select("text")
    # Texts that share a candidate's id have another set, so they find no class.
    sets = texts.mapInArrow(_sets(size), "same binary, shingles array<long>").join(told_reps.select("same", "rep"), "same")
    sets = stage(sets.groupBy("rep").agg(F.first("shingles").alias("shingles")), "sets")

    parts = [met.where(F.col("members") <= bucket_limit)]
    large, level = met.where(F.col("members") > bucket_limit), 1
    while level <= LEVELS:
        large, waiting = stage_counted(large.select("rep").distinct(), "large")
        if not waiting:
            break
        longer = sets.join(large, "rep", "left_semi").mapInArrow(_longer(*band_shape(percent, level)), "rep long, keys array<long>")
        members = longer.select("rep", F.explode("keys").alias("bucket"))
        crowded = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("centre")).where("members > 1")
        longer = stage(salted_join(members, crowded, ["bucket"], F.col("rep"), "inner"), "members")
        last = level == LEVELS
        parts.append(longer if last else longer.where(F.col("members") <= bucket_limit))
        large, level = longer.where(F.col("members") > bucket_limit), level + 1
    buckets = reduce(DataFrame.unionByName, parts)

    pairs = buckets.where("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    stars = salted_join(pairs, _side(told_reps, "a"), ["a"], F.col("b"), "inner").join(_side(told_reps, "b"), "b")
    links = stage(_confirmed(stars.where(_plausible(percent)).select("a", "b", "n_a", "n_b"), sets, percent), "links")
    named = connected_components(links)
    apart = buckets.select("bucket", "rep").join(named.withColumnRenamed("node", "rep"), "rep", "left")
    apart = stage(apart.select("bucket", "rep", F.coalesce("component", "rep").alias("component")), "apart")
    counted = apart.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("most"), F.count(F.lit(1)).alias("k")).where("k > 1")
    largest = largest.select("bucket", F.col("most.component").alias("largest"))
    # Sketches are wide, so they join only where a bucket has several components.
    open_ = salted_join(apart, largest, ["bucket"], F.col("rep"), "inner")
    open_ = stage(open_.join(told_reps.select("rep", "n_shingles", "lanes", "odd"), "rep"), "open")
    outside = open_.where("component != largest").select(
        "bucket", F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("lanes").alias("lanes_a"),
        F.col("odd").alias("odd_a"), F.col("component").alias("mine"))
    theirs = open_.select(
        F.col("bucket").alias("place"), F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("lanes").alias("lanes_b"),
        F.col("odd").alias("odd_b"), F.col("component").alias("other"), (F.col("component") != F.col("largest")).alias("outside"))
    # only pairs that may be alike leave the join
    apart_yet = (F.col("bucket") == F.col("place")) & (F.col("mine") != F.col("other")) & (~F.col("outside") | (F.col("a") < F.col("b")))
    left = outside.join(theirs, apart_yet & _plausible(percent))
    low = F.col("a") < F.col("b")
    left = left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(low, F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
                       F.when(low, F.col("n_b")).otherwise(F.col("n_a")).alias("n_b")).distinct().join(pairs, ["a", "b"], "left_anti")
    more = stage(_confirmed(left, sets, percent), "links")
    known = named.select(F.col("node").alias("a"), F.col("component").alias("b"))  # stars already: few rounds are left
    named = connected_components(known.unionByName(more))

    twice = linked.groupBy("doc_id").agg(F.min("same").alias("least"), F.max("same").alias("most")).where("least <> most")
    twice, shared = stage_counted(twice.select("doc_id"), "shared_ids")
    if shared:  # rows of one id are one document, whatever their texts
        held = linked.join(twice, "doc_id", "left_semi").select("doc_id", "same").distinct().join(classes.select("same", "rep"), "same")
        star = held.groupBy("doc_id").agg(F.min("rep").alias("b"))
        one = held.join(star, "doc_id").select(F.col("rep").alias("a"), "b")
        named = connected_components(named.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(one))

    placed = classes.join(named.withColumnRenamed("node", "rep"), "rep", "left").where("copies > 1 OR component IS NOT NULL")
    placed = stage(placed.select("same", F.coalesce("component", "rep").alias("component"), "doc_id"), "placed")
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = salted_join(placed.select("same", "component"), least, ["component"], F.col("same"), "inner").select("same", "component_id")
    result = salted_join(told.select("doc_id", "n_shingles", "same"), by_class, ["same"], F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))
