"""Exact top-k search by inner product, with a table of distances to pivots that rules candidates out.

For vectors q and x, 2 q.x = |q|^2 + |x|^2 - |q - x|^2, and for every pivot p the triangle inequality gives
|q - x| >= | |q - p| - |x - p| |. The largest of these bounds over all pivots bounds the score from above. Candidates
are evaluated in the order of their bounds, until the next bound is below the k-th best score.

Queries and candidates are dealt into blocks; every pair of blocks meets once, by an equi-join. Blocks of candidates
come in waves, the first ones small: the k-th best score that a query has found in one wave is where it stops in the
next, so pivots rule out by what all earlier blocks hold.

Blocks travel as the narrowest integers that hold them, without distances, which the task that searches takes again:
each block of queries is copied for each of candidates, and the other way round. Copies go through a shuffle. Spark's
size of a plan knows nothing of them, so the hint keeps it from sending them all through the driver as a broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillmill.session import ship
from quillmill.staging import stage, stage_counted

PIVOTS = 24
BLOCK = 4096
"""Vectors of a block on average."""
QUERY_BLOCK = 4
"""Times as many queries in one of theirs, which is how often the table is copied less."""
STEP = 64
"""Candidates that a query evaluates first."""
SAMPLE = 256
"""Candidates, about, by which to judge how many of a block the bounds rule out."""
SCALE = 256
WAVES = 3
"""Waves of candidate blocks; each has eight times as many as the one before, the last one all that are left."""


def quantise(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that take part, and their vectors as floor(256 * x) in 64-bit integers."""
    rows, vectors = [], []
    for i, one in enumerate(batch.column("embedding")):
        if not one.is_valid or one.values.null_count:
            continue
        x = np.asarray(one.values.to_numpy(zero_copy_only=False), np.float64)
        if np.isfinite(x).all():
            rows.append(i)
            vectors.append(np.floor(SCALE * x).astype(np.int64))
    return np.array(rows, np.int64), vectors


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """A row for each vector, a column for each pivot."""
    real, far = vectors.astype(np.float64), np.zeros((len(vectors), len(pivots)))
    for i, pivot in enumerate(pivots.astype(np.float64)):
        far[:, i] = np.sqrt(((real - pivot) ** 2).sum(1))
    return far


def narrow(vectors: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest integers that hold them."""
    for kind in (np.int16, np.int32):
        held = np.iinfo(kind)
        if vectors.size and held.min <= vectors.min() and vectors.max() <= held.max:
            return vectors.astype(kind)
    return vectors


def widened(data: bytes, rows: int, size: int) -> np.ndarray:
    """What `narrow` was given, from the bytes of its result."""
    width = len(data) // (rows * size) if rows * size else 8
    return np.frombuffer(data, f"i{width}").reshape(rows, size).astype(np.int64)


def _bounds(q_norm: float, q_far: np.ndarray, x_norm: np.ndarray, by_pivot: np.ndarray) -> np.ndarray:
    """What the scores of candidates are at most, with a margin for rounding."""
    gap = np.abs(by_pivot - q_far[:, None]).max(0) if len(by_pivot) else np.zeros(len(x_norm))
    return (q_norm + x_norm - gap * gap) / 2 + 1e-9 * (q_norm + x_norm) + 1


def search_block(q_ids, q, q_far, ids, x, x_far, k: int, floors: dict[int, int] | None = None) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best in the block, ties to the smaller id.

    A candidate with the query's own id is not one. Each step evaluates twice as many candidates as the last. `floors`
    are scores of which a query has k elsewhere; candidates below them are left out. Where a sample of the bounds says
    that they leave most of the block above the floor, order gains nothing: all its candidates are evaluated at once.
    """
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    floors = floors or {}
    q_real, x_real = q.astype(np.float64), x.astype(np.float64)
    q_norm, x_norm = (q_real**2).sum(1), (x_real**2).sum(1)
    exact = q.size and x.size and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < 2**52
    by_pivot = np.ascontiguousarray(x_far.T)
    some = slice(None, None, max(1, len(ids) // SAMPLE))
    sample, sample_norm = np.ascontiguousarray(by_pivot[:, some]), x_norm[some]

    def best_of(scores: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = np.lexsort((of, -scores))[:k]
        return scores[top], of[top]

    def few_ruled_out(i: int) -> bool:
        floor = floors.get(int(q_ids[i]))
        return floor is not None and 2 * np.count_nonzero(_bounds(q_norm[i], q_far[i], sample_norm, sample) >= floor) > len(sample_norm)

    at_once = [i for i in range(len(q_ids)) if few_ruled_out(i)]
    for start in range(0, len(at_once), STEP):
        rows = at_once[start : start + STEP]
        for i, scores in zip(rows, q_real[rows] @ x_real.T if exact else q[rows] @ x.T, strict=True):
            well = np.flatnonzero(scores >= floors[int(q_ids[i])])
            well = well[ids[well] != q_ids[i]]
            found[i] = best_of(scores[well].astype(np.int64), ids[well])

    for i in range(len(q_ids)):
        if i in found:
            continue
        floor = floors.get(int(q_ids[i]))
        bound = _bounds(q_norm[i], q_far[i], x_norm, by_pivot)
        order = np.flatnonzero(ids != q_ids[i] if floor is None else (ids != q_ids[i]) & (bound >= floor))
        order = order[np.argsort(-bound[order], kind="stable")]
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        start, step = 0, STEP
        while start < len(order) and not (len(best) == k and bound[order[start]] < best[-1]):
            some = order[start : start + step]
            scores = (x_real[some] @ q_real[i]).astype(np.int64) if exact else x[some] @ q[i]
            start, step = start + step, 2 * step
            if floor is not None:
                well = scores >= floor
                some, scores = some[well], scores[well]
            if len(best) == k:
                well = scores >= best[-1]
                some, scores = some[well], scores[well]
            best, best_ids = best_of(np.concatenate([best, scores]), np.concatenate([best_ids, ids[some]]))
        found[i] = best, best_ids
    return [(int(q_ids[i]), int(a), int(b)) for i, (best, best_ids) in sorted(found.items()) for a, b in zip(best_ids, best, strict=True)]


def _packed(table: pa.Table) -> pa.Table:
    """A block's vectors in one row for each length they have."""
    out = []
    for batch in table.combine_chunks().to_batches():
        rows, vectors = quantise(batch)
        ids = batch.column("vec_id").to_numpy(zero_copy_only=False)[rows].astype(np.int64)
        sizes = np.array([len(v) for v in vectors], np.int64)
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            x = np.array([vectors[i] for i in at], np.int64).reshape(len(at), size)
            out.append((size, batch.column("block")[0].as_py(), ids[at].tobytes(), narrow(x).tobytes()))
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*out, strict=True)) if out else [[]] * 4
    return pa.table([pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], ["size", "block", "ids", "vectors"])


def _search(k: int, pivots):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = {len(p): np.array([v for v in pivots.value if len(v) == len(p)], np.int64) for p in pivots.value}
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                size = row["size"]
                q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                q, x = widened(row["q_vectors"], len(q_ids), size), widened(row["vectors"], len(ids), size)
                near = chosen.get(size, np.zeros((0, size), np.int64))
                floors = {floor["query_id"]: floor["score"] for floor in row["floors"] or ()}
                found = search_block(q_ids, q, distances(q, near), ids, x, distances(x, near), k, floors)
                if found:
                    columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["q_block"]] * len(found), pa.int32()), pa.array([size] * len(found), pa.int32()), *columns],
                        ["q_block", "size", "query_id", "vec_id", "score"])
    return search


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> list[list[int]]:
    """`pivots` quantised vectors of each length among a fixed-size pool: those whose id hashes lowest."""
    pool = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(8 * pivots).select("vec_id", "embedding").toArrow()
    chosen: dict[int, list[list[int]]] = {}
    for batch in pool.to_batches():
        for vector in quantise(batch)[1]:
            some = chosen.setdefault(len(vector), [])
            if len(some) < pivots and vector.tolist() not in some:
                some.append(vector.tolist())
    return [vector for some in chosen.values() for vector in some]


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """`query_id, rank, vec_id, score`: the k best candidates of each query (all, if there are fewer).

    Queries are the rows whose vec_id is divisible by `every`; candidates are all rows but those with
    the query's own id. Scores are integer inner products of floor(256 x); ties go to the smaller vec_id.
    Vectors that are null or hold a null or a value that is not finite take no part, nor do rows without
    vec_id. Vectors meet only others of their length; two empty ones score 0. Rows that repeat a vec_id are
    candidates of their own for others. Components beyond 2^20 or so may wrap as 64-bit integers do.
    """
    spark = ship(vectors.sparkSession)
    told, rows = stage_counted(vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long"), "embedding"), "vectors")
    sent = spark.sparkContext.broadcast(choose_pivots(told, pivots))
    n_blocks = max(1, math.ceil(rows / block))
    q_blocks = max(1, math.ceil(rows / every / (QUERY_BLOCK * block)))
    kind = "size int, block int, ids binary, vectors binary"

    def blocks_of(df: DataFrame, n: int) -> DataFrame:
        place = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)).cast("int")
        return df.withColumn("block", place).groupBy("block").applyInArrow(_packed, kind)

    theirs = stage(blocks_of(told, n_blocks), "blocks")
    asked = blocks_of(told.where(F.col("vec_id") % every == 0), q_blocks)
    asked = stage(asked.select("size", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")), "queries")
    # The query's own block and size, since rows that share an id may be in several.
    own, kinds = ["q_block", "size", "query_id"], "q_block int, size int, query_id long, vec_id long, score long"
    best, start = None, 0
    for wave in range(WAVES):
        stop = n_blocks if wave == WAVES - 1 else min(n_blocks, start + max(1, n_blocks * 8**wave // 8 ** (WAVES - 1)))
        if start == stop:
            break
        some = theirs.where(F.col("block").between(start, stop - 1)).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        with_floors = asked.withColumn("floors", F.lit(None).cast("array<struct<query_id: long, score: long>>"))
        if best is not None:
            reached = best.where(F.col("place") == k).groupBy("q_block", "size").agg(F.collect_list(F.struct("query_id", "score")).alias("floors"))
            with_floors = asked.join(reached.hint("merge"), ["q_block", "size"], "left")
        blocks = F.explode(F.sequence(F.lit(start), F.lit(stop - 1)))
        met = with_floors.withColumn("block", blocks).join(some.hint("merge"), ["size", "block", "q_block"])
        found = met.mapInArrow(_search(k, sent), kinds)
        found = found if best is None else found.unionByName(best.drop("place"))
        place = F.row_number().over(Window.partitionBy(*own).orderBy(F.desc("score"), "vec_id"))
        best, start = stage(found.withColumn("place", place).where(F.col("place") <= k), "best"), stop
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
