"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Each source's target says how often each of its documents is taken on average: a whole number
of times plus a fraction, the copy probability. Rounding the fractions one by one would miss the
target; pivotal rounding pairs two documents and moves words from one to the other, either way with
the odds that keep both expectations, until one of them is whole. What it has left meets the
next one. The source's words thus stay exactly on target but for the last document.

Blocks of documents fold in parallel. Each leaves at most one document that is not whole; those
meet in the blocks of the next level, a tree that ends with one document for each source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from quillmill.session import ship
from quillmill.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
BLOCK = 128
"""Documents a block of the tree has on average."""
_UNIT = "struct<order:bigint,id:string,size:bigint,whole:bigint,part:double,row:{row}>"


def count_words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text (null: 0)."""
    gaps = F.translate(text, "\t\n\u000b\f\r", "     ")
    padded = F.concat(F.lit(" "), gaps)
    # a word starts at each space that is followed by something else
    starts = F.length(F.regexp_replace(padded, " (?=[^ ])", "")) - F.length(padded)
    return F.coalesce(-starts, F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """`source, source_size, target` from `source, source_size`.

    Sources in code point order (null last) weigh `weights`, repeating, and divide `share` of
    all words. A target above `limit` times its source stops there and the excess goes to the
    others by weight, until none is above: targets are then min(limit * size, level * weight),
    and the level follows from the order in which sources fill up. One row per source is
    sorted in one task; documents are not.
    """
    w, cap, ratio = "weight of the source", "most of the source", "filled at"
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn(w, F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double"))
    ranked = ranked.withColumn(cap, F.col("source_size") * F.lit(limit)).withColumn(ratio, F.col(cap) / F.col(w))
    every = Window.partitionBy()
    filling = Window.orderBy(ratio, "place")
    total = F.sum("source_size").over(every) * F.lit(share)
    before = F.coalesce(F.sum(cap).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum(w).over(filling.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", (total - before) / open_)
    # the first source in this order that the level does not fill, and all after it, take by weight
    level = F.min(F.when(F.col("level") < F.col(ratio), F.struct(ratio, "place", "level"))).over(every)["level"]
    return ranked.select("source", "source_size", F.least(cap, F.coalesce(level * F.col(w), F.col(cap))).alias("target"))


def _toss(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its inputs."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(2**52)) / F.lit(float(2**52))


def _meet(state: Column, unit: Column, seed: int, unit_type: str) -> Column:
    """Pair the document in hand with the next: move words until one of the two is whole."""
    held = state["held"]
    a, b = held["size"], unit["size"]
    p, q = held["part"], unit["part"]
    up = F.least(a * (1 - p), b * q)  # words the one in hand can take over
    down = F.least(a * p, b * (1 - q))  # words it can give
    gains = _toss(seed, held["id"], unit["id"]) * (up + down) < down
    moved = F.when(gains, up).otherwise(-down)
    held_whole = F.when(gains, a * (1 - p) <= b * q).otherwise(a * p <= b * (1 - q))

    def settled(one: Column, more: Column) -> Column:
        return one.withField("whole", one["whole"] + more.cast("bigint")).withField("part", F.lit(0.0))

    new_p, new_q = p + moved / a, q - moved / b
    done = F.when(held_whole, settled(held, F.when(gains, 1).otherwise(0))).otherwise(settled(unit, F.when(gains, 0).otherwise(1)))
    left = F.when(held_whole, unit.withField("part", new_q)).otherwise(held.withField("part", new_p))
    met = F.struct(left.cast(unit_type).alias("held"), F.concat(state["done"], F.array(done.cast(unit_type))).alias("done"))
    first = F.struct(unit.cast(unit_type).alias("held"), state["done"].alias("done"))
    return F.when(held.isNull(), first).otherwise(met)


def numbered(sizes: DataFrame) -> DataFrame:
    """`number`: 0, 1, ... among the rows alike in id, source and size, so that each has a place of its own.

    `part` says where a row was read. Rows are numbered within their part and the counts of earlier parts are added, so
    no task sees all rows of a group. Tables without such groups, which one count tells, are left as they are.
    """
    key = F.to_json(F.struct("doc_id", "source", "size"))
    keyed = sizes.withColumn("key", key)
    repeated = keyed.groupBy("key").count().where("count > 1")
    if repeated.isEmpty():
        return sizes.withColumn("number", F.lit(0).cast("bigint")).drop("part")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("key", "part").count().select(
        "key", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    local = F.row_number().over(Window.partitionBy("key", "part").orderBy(F.lit(0)))
    ranked = keyed.withColumn("local", local).join(starts, ["key", "part"])
    return ranked.withColumn("number", F.col("start") + F.col("local") - 1).drop("key", "part", "start", "local")


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT, seed: int = 1, block: int = BLOCK, keep: str | None = None,
) -> DataFrame:
    """`doc_id, size, source_size, target, taken` for every row of `docs`; `copies` is taken / size.

    Size is the number of words. A document is taken whole, 0, 1 or more times, never above
    `limit` times rounded up; sources and targets as in `source_targets`, a null source being one of
    its own. Documents without words are taken 0 times (0 words). The outcome depends on ids,
    sizes, sources and `seed` only, so reruns agree; of rows that are equal in these each has its own chance, but
    which is which is told by nothing. An empty table gives an empty result. `keep` names one more column to hand on.
    """
    ship(docs.sparkSession)
    seen = Observation()
    kept = F.col(f"`{keep}`") if keep else F.lit(None).cast("int")
    told = stage(docs.select(
        "doc_id", "source", count_words(F.col("text")).alias("size"), kept.alias("kept"), F.spark_partition_id().alias("part"),
    ).observe(seen, F.count(F.lit(1)).alias("rows")), "sizes")
    sizes = told.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    counts = sizes.select("source", "documents")
    targets = stage(source_targets(sizes.drop("documents"), weights, share, limit).join(
        counts.withColumnRenamed("source", "other"), F.col("source").eqNullSafe(F.col("other"))).drop("other"), "targets")

    row = "struct<doc_id:{},source_size:bigint,target:double,kept:{}>".format(
        dict(docs.dtypes)["doc_id"], dict(docs.dtypes)[keep] if keep else "int")
    unit_type = _UNIT.format(row=row)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = numbered(told).join(targets.withColumnRenamed("source", "its source"), F.col("source").eqNullSafe(F.col("its source"))).drop("its source")
    unit = F.struct(
        (-F.col("size")).alias("order"), F.concat_ws(
            ":", F.col("doc_id").cast("string"), F.col("size").cast("string"), F.when(F.col("number") > 0, F.col("number").cast("string"))).alias("id"), "size",
        F.floor(rate).cast("bigint").alias("whole"), (rate - F.floor(rate)).alias("part"),
        F.struct("doc_id", "source_size", "target", "kept").alias("row")).cast(unit_type)
    units = named.select("source", "documents", unit.alias("unit"))
    whole = (F.col("unit.part") <= 0) | (F.col("unit.size") == 0)
    results = [units.where(whole).select("unit")]
    open_ = units.where(~whole)
    level, most = 0, seen.get["rows"]
    while True:
        level += 1
        blocks = F.greatest(F.lit(1), F.ceil(F.col("documents") / float(block**level))).cast("bigint")
        place = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("unit.id")), blocks)
        gathered = open_.withColumn("place", place).groupBy("source", "documents", "place").agg(
            F.array_sort(F.collect_list("unit")).alias("units"))
        start = F.struct(F.lit(None).cast(unit_type).alias("held"), F.array().cast(f"array<{unit_type}>").alias("done"))
        folded = F.aggregate("units", start, lambda state, one: _meet(state, one, seed, unit_type))
        folded = stage(gathered.select("source", "documents", folded.alias("f")), f"mix{level}")
        results.append(folded.select(F.explode("f.done").alias("unit")))
        open_ = folded.where("f.held IS NOT NULL").select("source", "documents", F.col("f.held").alias("unit"))
        open_, done = open_.where("unit.part > 1e-12 AND unit.part < 1 - 1e-12"), open_.where("NOT (unit.part > 1e-12 AND unit.part < 1 - 1e-12)")
        results.append(done.select(F.col("unit").withField("whole", F.col("unit.whole") + F.round("unit.part").cast("bigint")).cast(unit_type).alias("unit")))
        if block**level >= max(1, most):
            break
    last = F.col("unit.whole") + F.when(_toss(seed, F.col("unit.id")) < F.col("unit.part"), 1).otherwise(0)
    results.append(open_.select(F.col("unit").withField("whole", last).cast(unit_type).alias("unit")))
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    return every.select(
        "unit.row.doc_id", "unit.size", "unit.row.source_size", "unit.row.target", *([F.col("unit.row.kept").alias(keep)] if keep else []),
        F.when(F.col("unit.size") > 0, F.col("unit.whole")).otherwise(0).cast("bigint").alias("copies"),
    ).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *([f"`{keep}`"] if keep else []))
