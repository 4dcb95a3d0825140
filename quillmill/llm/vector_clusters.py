"""Exact k-means over a VA-file: few-bit cells decide most assignments, full vectors are fetched for the rest.

Every vector is held twice, in blocks: as it is, and as one cell of `bits` bits for each dimension. For a set of
centroids, a lookup table has the least and the greatest squared distance of every cell of every dimension to every
centroid; summed over the dimensions they give an interval that holds the vector's distance. A centroid whose least
distance is above another's greatest one is out. Where one centroid is left, the vector is assigned; where several
intervals overlap, the full vector is fetched and decides.

Sums of the clusters are carried from round to round, so a round fetches only vectors that the cells leave open
under the old or the new centroids, and those that they move from one cluster to another. Nothing is kept for each
vector between rounds: what the cells say under the old centroids is worked out anew.

Both tables are bucketed by block, so fetching shuffles only the places of the vectors wanted. The driver holds the
centroids and the sums of their clusters.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from quillmill.session import ship
from quillmill.staging import stage, staging_path

CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 8, 10, 64, 1024
BITS = 6
BLOCK = 2048
"""Vectors of a block at most."""
SAMPLE = 2048
"""Vectors whose quantiles part the cells. They decide how many vectors are fetched, never a result."""
BUCKET_VECTORS = 2**16


class Cells:
    """The cells of each dimension: cell j holds the integers from low[d, j] to high[d, j]."""

    def __init__(self, sample: np.ndarray, least: np.ndarray, greatest: np.ndarray, bits: int) -> None:
        self.bits = bits
        parts = 2**bits
        inner = np.quantile(sample, np.arange(1, parts) / parts, axis=0, method="nearest").astype(np.int64).T
        self.marks = np.sort(np.clip(inner, least[:, None], greatest[:, None]), axis=1)
        self.low = np.concatenate([least[:, None], self.marks], axis=1)
        # A cell that holds no integer keeps its lower end only; nothing lies in it.
        self.high = np.maximum(np.concatenate([self.marks - 1, greatest[:, None]], axis=1), self.low)

    def packed(self, x: np.ndarray) -> bytes:
        """The vectors' cells, dimension after dimension, `bits` bits each."""
        cells = np.stack([np.searchsorted(marks, x[:, d], "right") for d, marks in enumerate(self.marks)])
        single = np.unpackbits(cells.astype(np.uint8)[..., None], axis=2)[..., 8 - self.bits :]
        return np.packbits(single.ravel()).tobytes()

    def unpacked(self, packed: bytes, n: int) -> np.ndarray:
        dims = len(self.marks)
        single = np.unpackbits(np.frombuffer(packed, np.uint8))[: dims * n * self.bits].reshape(dims, n, self.bits)
        whole = np.zeros((dims, n, 8), np.uint8)
        whole[..., 8 - self.bits :] = single
        return np.packbits(whole, axis=2)[..., 0]

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each dimension and cell: the least squared distances to all centroids, then the greatest ones; and by
        how much the distance to each centroid (second last axis) at most exceeds that to each other (last axis)."""
        at = centroids.T[:, None, :]
        below, above = self.low[:, :, None] - at, at - self.high[:, :, None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        greatest = np.maximum(np.abs(below), np.abs(above)) ** 2
        # The difference of two squared distances is linear in the component, so one of the cell's ends has the greatest.
        ends = [(end**2)[..., :, None] - (end**2)[..., None, :] for end in (below, above)]
        return np.concatenate([least, greatest], axis=2), np.maximum(*ends)

    def candidates(self, cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Per vector and centroid: may the centroid be a nearest one?

        Intervals that overlap are compared once more with the interval of their difference, which is the narrower
        the closer the centroids are.
        """
        intervals, excess = tables
        k = excess.shape[2]
        total = np.zeros((cells.shape[1], 2 * k), np.int64)
        for d, table in enumerate(intervals):
            total += table[cells[d]]
        may = total[:, :k] <= total[:, k:].min(axis=1)[:, None]
        several = np.flatnonzero(may.sum(axis=1) > 1)
        if len(several):
            middle = np.where(may[several], total[several, :k] + total[several, k:], np.iinfo(np.int64).max)
            chosen = middle.argmin(axis=1)
            more = np.zeros((len(several), k), np.int64)
            for d, table in enumerate(excess):
                more += table[cells[d, several], chosen]
            may[several] &= more >= 0
        return may


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors x centroids."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def nearest(x: np.ndarray, may: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid among those that may be it, ties to the smaller number. Distances decide only between several."""
    found = may.argmax(axis=1)
    several = np.flatnonzero(may.sum(axis=1) > 1)
    if len(several):
        far = np.where(may[several], squared(x[several], centroids), np.iinfo(np.int64).max)
        found[several] = far.argmin(axis=1)
    return found


def kept_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """`vec_id, x`: vectors with that many components, none null or not finite, as floor(scale * component)."""
    odd = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    real = F.transform("embedding", lambda v: v.cast("double"))
    return vectors.where((F.size("embedding") == dimensions) & ~F.exists(real, odd)).select(
        "vec_id", F.transform(real, lambda v: F.floor(v * scale)).alias("x"))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64, copy=False)


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors in numbered blocks; the number has the task's, so a task that is run again gives the same ones."""
    number = TaskContext.get().partitionId() << 32
    for whole in batches:
        for start in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(start, BLOCK)
            x = _matrix(batch.column("x"), batch.num_rows)
            ids = batch.column("vec_id")
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), ids, pa.array([x.tobytes()], pa.binary()),
                 pa.array([x.min(axis=0).tolist()]), pa.array([x.max(axis=0).tolist()])],
                ["block", "ids", "x", "least", "greatest"])
            number += 1


def _packed(cells: Cells, dimensions: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.frombuffer(x.as_py(), np.int64).reshape(-1, dimensions) for x in batch.column("x")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array([len(x) for x in vectors], pa.int32()),
                 pa.array([cells.packed(x) for x in vectors], pa.binary())], ["block", "n", "cells"])
    return pack


def _wanted(cells: Cells, old: np.ndarray, new: np.ndarray):
    """Places of the vectors to fetch: open under either set of centroids, or moved. With the candidates of both."""
    before, after = cells.tables(old), cells.tables(new)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, n, packed in zip(*(batch.column(name).to_pylist() for name in ("block", "n", "cells")), strict=True):
                held = cells.unpacked(packed, n)
                was, now = cells.candidates(held, before), cells.candidates(held, after)
                alike = (was.sum(axis=1) == 1) & (now.sum(axis=1) == 1) & (was == now).all(axis=1)
                at = np.flatnonzero(~alike)
                if len(at):
                    rows.append((block, at.astype(np.int32).tobytes(), np.packbits(was[at]).tobytes(), np.packbits(now[at]).tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], ["block", "at", "was", "now"])
    return wanted


def _bits(packed: bytes, n: int, k: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8))[: n * k].reshape(n, k).astype(bool)


def _totals(totals: np.ndarray) -> pa.RecordBatch:
    slots = np.flatnonzero(totals)
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(totals.ravel()[slots], pa.int64())], ["slot", "total"])


def _add(totals: np.ndarray, cluster: np.ndarray, x: np.ndarray, sign: int) -> None:
    """Row c of `totals`: the number of vectors of cluster c, then their sum."""
    for c in np.unique(cluster):
        mine = x[cluster == c]
        totals[c, 0] += sign * len(mine)
        totals[c, 1:] += sign * mine.sum(axis=0)


def _moves(old: np.ndarray, new: np.ndarray):
    """What the fetched vectors take from their old clusters and add to their new ones."""
    def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = new.shape
        totals = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for x, at, was, now in zip(*(batch.column(name).to_pylist() for name in ("x", "at", "was", "now")), strict=True):
                at = np.frombuffer(at, np.int32)
                x = np.frombuffer(x, np.int64).reshape(-1, dims)[at]
                _add(totals, nearest(x, _bits(was, len(at), k), old), x, -1)
                _add(totals, nearest(x, _bits(now, len(at), k), new), x, 1)
        yield _totals(totals)
    return moves


def _first_totals(cells: Cells, centroids: np.ndarray):
    tables = cells.tables(centroids)

    def totals_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        totals = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            for x, n, packed in zip(*(batch.column(name).to_pylist() for name in ("x", "n", "cells")), strict=True):
                x = np.frombuffer(x, np.int64).reshape(n, dims)
                may = cells.candidates(cells.unpacked(packed, n), tables)
                _add(totals, nearest(x, may, centroids), x, 1)
        yield _totals(totals)
    return totals_of


def _assigned(cells: Cells, centroids: np.ndarray):
    tables = cells.tables(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = centroids.shape[1]
        for batch in batches:
            for row, (x, n, packed) in enumerate(zip(*(batch.column(name).to_pylist() for name in ("x", "n", "cells")), strict=True)):
                x = np.frombuffer(x, np.int64).reshape(n, dims)
                cluster = nearest(x, cells.candidates(cells.unpacked(packed, n), tables), centroids)
                distance = ((x - centroids[cluster]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    ["vec_id", "cluster", "distance"])
    return assign


def _bucketed(df: DataFrame, buckets: int, name: str) -> str:
    """Write `df` as a table bucketed by block, in the shared folder; the name it has in the catalog."""
    table = f"quillmill_{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, "block").write.bucketBy(buckets, "block").format("parquet").option(
        "path", staging_path(df.sparkSession, name)).saveAsTable(table)
    return table


def _sums(rows: DataFrame, k: int, dims: int) -> list[list[int]]:
    """Totals of all tasks, at most k x (dims + 1) numbers."""
    out = [[0] * (dims + 1) for _ in range(k)]
    for row in rows.groupBy("slot").agg(F.sum("total").alias("total")).collect():
        out[row.slot // (dims + 1)][row.slot % (dims + 1)] = row.total
    return out


def cluster_vectors(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
    seed: str = "3", bits: int = BITS,
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid` of every vector that takes part.

    Vectors with `dimensions` components, none null or not finite, take part, as integers floor(scale * component).
    Centroids 0, 1, ... start as the k of them with the smallest hex sha256 of `seed:vec_id`; of equal hashes
    (repeated ids) the smaller vector comes first, and rows without vec_id, which are clustered like any other, come
    last. In each of `rounds` rounds every vector goes to the nearest centroid by squared Euclidean distance (ties:
    the smaller number), and each centroid that got vectors becomes their mean, rounded down in each component; one
    that got none stays. The final centroids assign once more: `distance` is squared, `cluster_inertia` its sum over
    the cluster, `inertia` over all, `centroid` the array of the cluster's components.

    Every row counts, repeated ones too. With fewer than k vectors there are as many centroids as vectors; equal
    vectors may start several, of which those with greater numbers get none. Without vectors the result is empty.
    Components beyond 2^27 may wrap as 64-bit integers do. Other columns are not read.
    """
    spark = ship(vectors.sparkSession)
    kept = kept_vectors(vectors, dimensions, scale)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    sample = kept.orderBy(hashed.asc_nulls_last(), "x").limit(max(SAMPLE, k)).select("x").toArrow().column("x").combine_chunks()
    id_type = dict(kept.dtypes)["vec_id"]
    if not len(sample):
        return spark.createDataFrame(
            [], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    sample = _matrix(sample, len(sample))
    centroids = sample[:k]
    k = len(centroids)

    blocks = kept.mapInArrow(_in_blocks, f"block long, ids array<{id_type}>, x binary, least array<long>, greatest array<long>")
    buckets = max(spark.sparkContext.defaultParallelism, vectors.count() // BUCKET_VECTORS)
    full = _bucketed(blocks, buckets, "vectors")
    ends = spark.table(full).agg(
        F.array(*[F.min(F.col("least")[d]) for d in range(dimensions)]), F.array(*[F.max(F.col("greatest")[d]) for d in range(dimensions)])).first()
    cells = Cells(sample, np.array(ends[0], np.int64), np.array(ends[1], np.int64), bits)
    small = _bucketed(spark.table(full).select("block", "x").mapInArrow(
        _packed(cells, dimensions), "block long, n int, cells binary"), buckets, "cells")
    both = spark.table(full).select("block", "ids", "x").join(spark.table(small), "block")

    kind = "slot long, total long"
    sums = _sums(both.select("x", "n", "cells").mapInArrow(_first_totals(cells, centroids), kind), k, dimensions)
    for done in range(1, rounds + 1):
        old, centroids = centroids, np.array(
            [[s // row[0] for s in row[1:]] if row[0] else list(c) for row, c in zip(sums, centroids.tolist(), strict=True)], np.int64)
        if done == rounds or (old == centroids).all():
            break
        wanted = spark.table(small).mapInArrow(_wanted(cells, old, centroids), "block long, at binary, was binary, now binary")
        fetched = spark.table(full).select("block", "x").join(wanted, "block")
        moved = _sums(fetched.select("x", "at", "was", "now").mapInArrow(_moves(old, centroids), kind), k, dimensions)
        sums = [[a + b for a, b in zip(*pair, strict=True)] for pair in zip(sums, moved, strict=True)]

    found = stage(both.select("ids", "x", "n", "cells").mapInArrow(
        _assigned(cells, centroids), f"vec_id {id_type}, cluster int, distance long"), "assigned")
    for table in (full, small):
        spark.sql(f"DROP TABLE {table}")
    inertia = [0] * k
    for row in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect():
        inertia[row.cluster] = row.total

    def of_cluster(values: list) -> F.Column:
        return F.element_at(F.array(*values), F.col("cluster") + 1)

    return found.withColumns({
        "cluster_inertia": of_cluster([F.lit(one).cast("long") for one in inertia]),
        "inertia": F.lit(sum(inertia)).cast("long"),
        "centroid": of_cluster([F.array(*[F.lit(v).cast("long") for v in c]) for c in centroids.tolist()]),
    })
