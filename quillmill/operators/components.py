"""Connected components by grouped minima and joins, and joins whose hot keys are dealt over several tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from quillmill.staging import stage

SALTS = 8


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str = "left") -> DataFrame:
    """Equi-join in which each key's left rows are dealt over `SALTS` partitions.

    `right` has few rows for each key and is repeated once for every salt. `spread` is an
    expression over the left row that differs within a key; it must not be random, so that a
    task that is run again deals its rows as before.
    """
    salt = "salt of the join"
    salted = left.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, salt], how).drop(salt)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """`node, component` of every node of `edges` (columns a, b), component being its smallest node.

    Alternates the large-star and small-star steps (each a grouped minimum and a join) until the
    edges are stars. Every round is written to the shared folder, so a lost executor costs
    one round; only a count and a checksum reach the driver.
    """
    a, b = F.col("a"), F.col("b")
    links = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    links, mark = _round(links, name)
    while mark[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = (
            salted_join(both.where("v > u"), least, ["u"], F.col("v"), "inner")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        )
        large = stage(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = salted_join(large, least, ["u"], F.col("v"), "inner")
        small = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        links, now = _round(small.distinct(), name)
        if now == mark:
            break
        mark = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _round(links: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    seen = Observation()
    mark = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")]
    links = stage(links.observe(seen, *mark), name)
    return links, (seen.get["n"], seen.get["x"])
