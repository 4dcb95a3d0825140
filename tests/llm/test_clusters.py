"""k-means over cells, against plain Python with exact integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.llm.queries import op13_centroid_clusters
from quillmill.llm.vector_clusters import Cells, cluster_vectors, nearest, squared

KIND = "vec_id long, embedding array<float>, label int, cluster string, x int"


def whole(vector, scale):
    real = np.array(vector, np.float32).astype(float)
    return [math.floor(v * scale) for v in real]


def model(rows, k, rounds, scale, seed="3"):
    kept = [(i, whole(v, scale)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    hashed = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [v for _, v in sorted(kept, key=lambda row: (hashed(row[0]), row[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    assign = lambda: [min((far(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        mine = assign()
        for n in range(len(centroids)):
            some = [v for (_, v), (_, at) in zip(kept, mine) if at == n]
            if some:
                centroids[n] = [sum(column) // len(some) for column in zip(*some)]
    mine = assign()
    inertia = [sum(d for d, at in mine if at == n) for n in range(len(centroids))]
    return sorted(((i, at, d, inertia[at], sum(inertia), centroids[at]) for (i, _), (d, at) in zip(kept, mine)), key=str)


def some_rows():
    pick = random.Random(9)
    vector = lambda middle: [pick.gauss(middle, 0.1) for _ in range(64)]
    rows = [(i, vector(pick.choice([0, 0.3, -0.2]))) for i in range(150)]
    same = vector(0)
    rows += [(200 + i, same) for i in range(60)]
    rows += [(300, None), (301, []), (302, [0.5] * 63), (303, [0.5] * 63 + [None]), (304, [0.5] * 63 + [float("nan")]), (305, [float("inf")] * 64)]
    rows += [(None, vector(0)), (None, same), (5, vector(0.1)), (5, same), (306, [0.0] * 64), (307, [50.0] + [0.0] * 63)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], KIND).repartition(3)


def found(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in df.collect()), key=str)


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_against_plain_python(spark, bits):
    rows = some_rows()
    assert found(cluster_vectors(table(spark, rows), rounds=4, bits=bits)) == model(rows, 8, 4, 1024)


def test_few_vectors_and_none(spark):
    rows = some_rows()
    assert found(cluster_vectors(table(spark, rows[:3]), rounds=2)) == model(rows[:3], 8, 2, 1024)
    assert found(cluster_vectors(table(spark, [rows[160]] * 12), rounds=2)) == model([rows[160]] * 12, 8, 2, 1024)
    assert cluster_vectors(table(spark, [(1, None)])).collect() == []
    assert cluster_vectors(table(spark, [])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_no_table_is_left_behind(spark):
    before = spark.sql("SHOW TABLES").count()
    cluster_vectors(table(spark, some_rows()), rounds=1).collect()
    assert spark.sql("SHOW TABLES").count() == before


@pytest.mark.parametrize("bits", [1, 2, 5, 8])
def test_intervals_hold_the_nearest(bits):
    pick = np.random.default_rng(bits)
    x = pick.integers(-300, 300, (500, 64)) // pick.integers(1, 9, 64)
    x[:20] = x[0]
    centroids = np.concatenate([x[:3], x[300:303], x[300:301] + 1])
    cells = Cells(x[100:200], x.min(axis=0), x.max(axis=0), bits)
    held = cells.unpacked(cells.packed(x), len(x))
    may = cells.candidates(held, cells.tables(centroids))
    far = squared(x, centroids)
    assert may[far == far.min(axis=1)[:, None]].all()
    assert (nearest(x, may, centroids) == far.argmin(axis=1)).all()
    assert bits < 5 or may.sum(axis=1).min() == 1


def test_query(spark, tmp_path):
    rows = some_rows()
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(map(tuple, op13_centroid_clusters(spark, str(tmp_path)).collect()), key=str)
    want = [(*row[:5], hashlib.sha256(",".join(map(str, row[5])).encode()).hexdigest()) for row in model(rows, 8, 10, 1024)]
    assert got == sorted(want, key=str)
