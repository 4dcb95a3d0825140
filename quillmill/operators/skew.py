"""Joins and ordered sums that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from quillmill.staging import stage_counted

# A key is hot above this share of the rows, so there are never more than 10,000 hot keys.
HOT_SHARE = 10_000
# Below this many rows no key is worth splitting off.
HOT_FLOOR = 200_000
# Width of an order-key bucket in `running_total`; a window never holds more distinct order keys.
BUCKET_WIDTH = 1_000_000


def keyed_join(
    rows: DataFrame, keys: DataFrame, on: list[str], how: str, total: int, *, floor: int | None = None
) -> DataFrame:
    """Join `rows` (of which there are `total`) to `keys`, which is unique on `on`.

    Hot keys are found by counting, once, into a staged list of at most 10,000. Their rows are
    answered from a broadcast of their own few `keys` rows; all others go through an ordinary
    shuffle join. Rows with a null key match nothing and skip the shuffle, where they would
    all land in one task. `how`: left, left_semi or left_anti.
    """
    floor = HOT_FLOOR if floor is None else floor
    if total <= floor:
        return rows.join(keys, on, how)

    keyed, unkeyed = rows, None
    if any(field.nullable for field in rows.schema.fields if field.name in on):
        present = reduce(and_, [F.col(name).isNotNull() for name in on])
        keyed, unkeyed = rows.where(present), rows.where(~present)

    counted = keyed.groupBy(on).count().where(F.col("count") > max(floor, total // HOT_SHARE)).select(on)
    hot, number = stage_counted(counted, "hot_keys")
    if number:
        flagged = keyed.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), on, "left")
        hot_keys = keys.join(F.broadcast(hot), on, "left_semi")
        joined = (
            flagged.where("_hot").join(F.broadcast(hot_keys), on, how)
            .unionByName(flagged.where("_hot IS NULL").join(keys, on, how))
            .drop("_hot")
        )
    else:
        joined = keyed.join(keys, on, how)
    if unkeyed is not None and how != "left_semi":
        joined = joined.unionByName(unkeyed, allowMissingColumns=True)
    return joined


def running_total(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, *,
    tie: list[str] | None = None, width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Inclusive running sum of `value` along the integer column `order` within `keys`.

    Rows are windowed per bucket of `order` and the totals of earlier buckets are added, so a
    key holding most of the table is spread over as many tasks as it has buckets.
    """
    bucketed = df.withColumn("_bucket", F.expr(f"`{order}` DIV {width}"))
    place = [*keys, "_bucket"]
    sums = bucketed.groupBy(place).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*place, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(place).orderBy(order, *(tie or [])).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.withColumn("_local", F.sum(value).over(inside))
    return (
        local.join(offsets, place)
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_bucket", "_local", "_offset")
    )


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan with at least one task per core, for work that is heavy per row.

    Only a scan with fewer splits than cores is shuffled; any large one is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def spread_rows(rows: DataFrame, *keys: str) -> DataFrame:
    """Few rows with much work each, such as files to open, dealt evenly over tasks by their keys."""
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
