"""Collision-free document names, exactly as if handed out one post after the other.

A post asks for `{base}`, then `{base}-2`, `{base}-3`, ... and takes the first name still
free in its feed. Seen from one base, name number n can only be contested by a base that is
itself spelled `{base}-n`, whose first post asks for it as its own first choice. Such a
*contest* is settled by comparing two positions:

    c  names of the base lost to rivals so far      k = n - c  post that would take name n
    r  posts of the base before the rival's first   m          all posts of the base

    k <= r      the base takes name n, the rival starts at its own number 2
    r < k <= m  the rival has it, and every post from k on moves up by one
    k > m       the base never gets that far

Everything else is a running count. Contests with n > m + contests + 1 cannot matter and
are dropped at once, so usually there is nothing to settle and the number is the count.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quillmill.functions.text import date_prefix, slug
from quillmill.operators.skew import BUCKET_WIDTH, keyed_join, running_total, spread_rows
from quillmill.staging import stage, stage_counted

ROW = ["feed_path", "entry_index"]
BASE = ["feed_path", "base"]
RIVAL_NAME = r"(?s)\A(.*)-([1-9][0-9]{0,17})\z"
# Bases that differ only in numbers at the end are a family; contests never leave it.
FAMILY_NAME = r"(-[1-9][0-9]{0,17})+\z"
SETTLED = "feed_path STRING, base STRING, rival STRING, rank BIGINT"
# Contests of a family that one task settles alone; larger families go through their levels and ranges.
FAMILY_ROWS = 20_000


def with_base_name(posts: DataFrame, published: str = "published", title: str = "title") -> DataFrame:
    return posts.withColumn("base", F.concat(date_prefix(F.col(published)), F.lit("-"), slug(F.col(title))))


def file_names(
    posts: DataFrame, *, floor: int | None = None, width: int = BUCKET_WIDTH, family_rows: int = FAMILY_ROWS
) -> DataFrame:
    """Adds `file_name` to kept posts that carry a `base` name, which is dropped."""
    columns = [name for name in posts.columns if name != "base"]
    posts, total = stage_counted(posts.withColumn("one", F.lit(1)), "bases")
    ranked = running_total(posts, BASE, "entry_index", "one", "rank", width=width).drop("one")
    close, number = stage_counted(_close_contests(posts, total, floor), "contests")
    if number:
        contests = _with_posts_before(close, posts, total, floor, width)
        lost, starts = _settle_families(contests, total, floor, width, family_rows)
        numbered = _with_numbers(ranked, lost, starts, total, floor, width)
    else:
        numbered = ranked.withColumn("number", F.col("rank"))
    suffix = F.when(F.col("number") == 1, "").otherwise(F.concat(F.lit("-"), F.col("number").cast("string")))
    return numbered.select(*columns, F.concat("base", suffix, F.lit(".md")).alias("file_name"))


def _close_contests(posts: DataFrame, total: int, floor: int | None) -> DataFrame:
    """Pairs (base, rival spelled `{base}-n`) near enough to meet."""
    bases = posts.groupBy(BASE).agg(F.count("*").alias("m"), F.min("entry_index").alias("first"))
    rivals = (
        bases.select(
            "feed_path", F.col("base").alias("rival"), "first",
            F.regexp_extract("base", RIVAL_NAME, 1).alias("base"),
            F.expr(f"try_cast(regexp_extract(base, r'{RIVAL_NAME}', 2) AS BIGINT)").alias("n"),
        )
        .where("n >= 2")
    )
    paired = keyed_join(rivals, bases.drop("first"), BASE, "left", total, floor=floor).where("m IS NOT NULL")
    rival_counts = paired.groupBy(BASE).agg(F.count("*").alias("rivals"))
    return (
        keyed_join(paired, rival_counts, BASE, "left", total, floor=floor)
        .where("n <= m + rivals + 1").drop("rivals")
    )


def _with_posts_before(
    close: DataFrame, posts: DataFrame, total: int, floor: int | None, width: int
) -> DataFrame:
    """Adds `r`: both kinds are put on one line, and the posts counted along it."""
    contested = keyed_join(posts, close.select(BASE).distinct(), BASE, "left_semi", total, floor=floor)
    line = contested.select(*BASE, "entry_index", "one").unionByName(
        close.select(*BASE, F.col("first").alias("entry_index"), F.lit(0).alias("one"), "n", "rival", "m"),
        allowMissingColumns=True,
    )
    return (
        running_total(line, BASE, "entry_index", "one", "r", width=width)
        .where("n IS NOT NULL").select("feed_path", "base", "n", "rival", "r", "m")
    )


def _settled_parts(settled: DataFrame) -> tuple[DataFrame, DataFrame]:
    lost = settled.where("rank IS NOT NULL").select(*BASE, "rank")
    return lost, settled.where("rival IS NOT NULL").select("feed_path", F.col("rival").alias("base"))


def _settle_families(
    contests: DataFrame, total: int, floor: int | None, width: int, family_rows: int
) -> tuple[DataFrame, DataFrame]:
    """`_settle`, with every family of up to `family_rows` contests in one group."""
    family = ["feed_path", "family"]
    contests = stage(contests.withColumn("family", F.regexp_replace("base", FAMILY_NAME, "")), "contests")
    large = contests.groupBy(family).count().where(F.col("count") > family_rows).select(family)
    large, number = stage_counted(large, "large_families")
    small = keyed_join(contests, large, family, "left_anti", total, floor=floor) if number else contests

    def settle_family(rows: pd.DataFrame) -> pd.DataFrame:
        """Shorter spellings first: a base knows whether it has lost its own first name before it hands out others."""
        without_first, settled = set(), []
        for base, group in sorted(rows.groupby("base"), key=lambda group: len(group[0])):
            settled.append(_settle_base(group.assign(c=int(base in without_first))))
            without_first.update(settled[-1]["rival"].dropna())
        return pd.concat(settled)

    # Contests are few bytes, but a group of them is work: adaptive execution would put all into one task.
    spread = spread_rows(small, *family)
    lost, starts = _settled_parts(stage(spread.groupBy(family).applyInPandas(settle_family, SETTLED), "settled"))
    if number:
        rest = keyed_join(contests, large, family, "left_semi", total, floor=floor).drop("family")
        more_lost, more_starts = _settle(rest, total, floor, width)
        lost, starts = lost.unionByName(more_lost), starts.unionByName(more_starts)
    return lost, starts


def _settle(contests: DataFrame, total: int, floor: int | None, width: int) -> tuple[DataFrame, DataFrame]:
    """Names lost (`feed_path, base, rank`: posts from `rank` on move up) and bases that lost
    their first name (`feed_path, base`).

    A base is settled once its own first name is: level by level down the spelling, and
    within a level by ranges of n, so that a task sees at most `width` rivals of a base.
    """
    spark = contests.sparkSession
    lost = spark.createDataFrame([], "feed_path STRING, base STRING, rank BIGINT")
    starts = spark.createDataFrame([], "feed_path STRING, base STRING")
    pending, left = stage_counted(contests, "pending")
    while left:
        open_rivals = pending.select("feed_path", F.col("rival").alias("base"))
        ready = pending.select(BASE).distinct().join(open_rivals, BASE, "left_anti")
        ready = stage(
            ready.join(starts.withColumn("c", F.lit(1).cast("bigint")), BASE, "left").na.fill(0, ["c"]), "ready"
        )
        level = stage(keyed_join(pending, ready.select(BASE), BASE, "left_semi", total, floor=floor), "level")
        carry = ready
        for part in _parts(level, width):
            current = level.where(F.expr(f"n DIV {width}") == part).join(carry, BASE)
            settled = stage(current.groupBy(BASE).applyInPandas(_settle_base, SETTLED), "settled")
            moved, won = _settled_parts(settled)
            lost, starts = lost.unionByName(moved), starts.unionByName(won)
            carry = stage(
                carry.unionByName(moved.groupBy(BASE).agg(F.count("*").alias("c")))
                .groupBy(BASE).agg(F.sum("c").alias("c")), "carry")
        pending, left = stage_counted(
            keyed_join(pending, ready.select(BASE), BASE, "left_anti", total, floor=floor), "pending")
    return lost, starts


def _parts(level: DataFrame, width: int) -> list[int]:
    """Ranges of n in use; n is at most rows of the base plus its rivals, so they are few."""
    return sorted(row[0] for row in level.select(F.expr(f"n DIV {width}")).distinct().toLocalIterator())


def _settle_base(contests: pd.DataFrame) -> pd.DataFrame:
    contests = contests.sort_values("n")
    feed, base, c = contests["feed_path"].iat[0], contests["base"].iat[0], int(contests["c"].iat[0])
    out = []
    for n, rival, r, m in zip(contests["n"], contests["rival"], contests["r"], contests["m"]):
        k = n - c
        if k <= r:
            out.append((feed, base, rival, None))
        elif k <= m:
            out.append((feed, base, None, k))
            c += 1
    result = pd.DataFrame(out, columns=["feed_path", "base", "rival", "rank"])
    return result.astype({"rank": "Int64", "rival": "object"})


def _with_numbers(
    ranked: DataFrame, lost: DataFrame, starts: DataFrame, total: int, floor: int | None, width: int
) -> DataFrame:
    """`number` = rank + names lost up to that rank (+ 1 if the base lost its first name)."""
    moves = lost.unionByName(starts.withColumn("rank", F.lit(1).cast("bigint")))
    moves = moves.groupBy(*BASE, "rank").agg(F.count("*").alias("step"))
    moved_bases = moves.select(BASE).distinct()
    quiet = keyed_join(ranked, moved_bases, BASE, "left_anti", total, floor=floor)
    moving = keyed_join(ranked, moved_bases, BASE, "left_semi", total, floor=floor)
    line = moving.withColumn("step", F.lit(0).cast("bigint")).unionByName(moves, allowMissingColumns=True)
    shifted = running_total(
        line, BASE, "rank", "step", "shift", tie=["entry_index"], width=width
    ).where("entry_index IS NOT NULL")
    return quiet.withColumn("number", F.col("rank")).unionByName(
        shifted.withColumn("number", F.col("rank") + F.col("shift")).drop("step", "shift")
    )
