"""First-wins removal of posts that repeat the id or the URL of a *kept* post.

A dropped post reserves nothing, so whether a post stays depends on earlier decisions. Each
round keeps every undecided post that comes first for both its id and its URL, and drops
the posts that share a key with one of those. Rounds only see what is still undecided,
which shrinks fast. What a few rounds leave are chains of posts that alternately share ids and
URLs: apart from each other they decide nothing together, so each connected component is
settled by one ordered pass of its own.

Ids and URLs are compared per feed.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from quillmill.operators.components import connected_components
from quillmill.operators.skew import keyed_join
from quillmill.staging import stage, stage_counted, staging_path

ID = ["feed_path", "id"]
URL = ["feed_path", "url"]
ROW = ["feed_path", "entry_index"]
# Fixed texts of the report format: what is repeated, and the file that has it.
SAME_ID = "Duplicate post ID encountered: '%s' (already seen as '%s')"
SAME_URL = "Duplicate canonical URL encountered: '%s' (already seen as '%s')"
# Rounds over all that is undecided, before what is left is taken apart.
ROUNDS = 3


def kept_posts(posts: DataFrame, *, rounds: int = ROUNDS, floor: int | None = None) -> DataFrame:
    """`feed_path, entry_index, id, url` of the posts that stay; a blank URL is no key."""
    # Of posts with equal id and URL only the first can ever be kept: copies go before any join.
    undecided, left = stage_counted(
        posts.select("feed_path", "entry_index", "id", F.expr("nullif(url, '')").alias("url"))
        .groupBy("feed_path", "id", "url").agg(F.min("entry_index").alias("entry_index")),
        "undecided",
    )
    spark, schema = posts.sparkSession, undecided.select(*ROW, "id", "url").schema
    folder = staging_path(spark, "kept")

    def keep_round(number: int, keep: DataFrame) -> DataFrame:
        path = f"{folder}/round={number}"
        keep.select(schema.names).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    number = 0
    while left and number < rounds:
        keep = keep_round(number, _first_on_both(undecided))
        rest = keyed_join(undecided, keep.select(ID), ID, "left_anti", left, floor=floor)
        rest = keyed_join(rest, keep.where("url IS NOT NULL").select(URL), URL, "left_anti", left, floor=floor)
        undecided, left = stage_counted(rest, "undecided")
        number += 1
    if left or not number:
        keep_round(number, _settle(undecided, left, floor) if left else undecided)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)


def _first_on_both(posts: DataFrame) -> DataFrame:
    """Posts that are the earliest holder of their id and, if they have one, of their URL.

    Both sides are one row per key after partial aggregation and meet on the entry itself,
    so a key shared by most posts skews nothing.
    """
    by_id = posts.groupBy(ID).agg(
        F.min_by(F.struct("entry_index", "url"), "entry_index").alias("first")
    ).select(*ID, "first.*")
    by_url = posts.where("url IS NOT NULL").groupBy(URL).agg(F.min("entry_index").alias("entry_index"))
    first_of_url = by_url.select(*ROW, F.lit(True).alias("first_of_url"))
    return by_id.join(first_of_url, ROW, "left").where("url IS NULL OR first_of_url").drop("first_of_url")


def _settle(posts: DataFrame, total: int, floor: int | None) -> DataFrame:
    """The posts that stay, each component decided in the order of its entries. A task streams through its components
    one after the other and holds the keys of one at a time."""
    schema = posts.schema
    posts = stage(posts.withColumn("post", F.monotonically_increasing_id()), "open_posts")
    links = None
    for key, some in ((ID, posts), (URL, posts.where("url IS NOT NULL"))):
        # A star for each key, around its first post.
        centres = some.groupBy(key).agg(F.min("post").alias("centre"))
        star = keyed_join(some.select(*key, "post"), centres, key, "left", total, floor=floor).select(
            F.col("post").alias("a"), F.col("centre").alias("b"))
        links = star if links is None else links.unionByName(star)
    parts = connected_components(links, "posts").withColumnRenamed("node", "post")
    found = posts.join(parts, "post", "left").withColumn("component", F.coalesce("component", "post")).drop("post")

    def ordered_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, now = set(), None
        for batch in batches:
            stays = []
            for component, feed, post_id, link in zip(*(batch[name] for name in ("component", "feed_path", "id", "url"))):
                if component != now:
                    seen, now = set(), component
                keys = {("id", feed, post_id)} | ({("url", feed, link)} if link is not None else set())
                stays.append(seen.isdisjoint(keys))
                if stays[-1]:
                    seen |= keys
            yield batch.loc[stays, schema.names]

    return found.repartition("component").sortWithinPartitions("component", *ROW).mapInPandas(ordered_pass, schema)


def duplicate_posts(posts: DataFrame, kept: DataFrame, total: int, *, floor: int | None = None) -> DataFrame:
    """Dropped posts with the file of the earlier post they repeat and the reason.

    `kept` carries `file_name`. The id is looked up first; either key counts only if its
    kept holder came earlier.
    """
    dropped = posts.select(*ROW, "id", "title", "url").join(kept.select(ROW), ROW, "left_anti")
    holder_of_id = kept.select(
        *ID, F.col("entry_index").alias("id_at"), F.col("file_name").alias("id_file")
    )
    holder_of_url = kept.where("url IS NOT NULL").select(
        *URL, F.col("entry_index").alias("url_at"), F.col("file_name").alias("url_file")
    )
    found = keyed_join(dropped, holder_of_id, ID, "left", total, floor=floor)
    found = keyed_join(found, holder_of_url, URL, "left", total, floor=floor)
    same_id = F.coalesce(F.col("id_at") < F.col("entry_index"), F.lit(False))
    first_file = F.when(same_id, F.col("id_file")).otherwise(F.col("url_file"))
    reason = F.when(same_id, F.format_string(SAME_ID, "id", first_file)).otherwise(
        F.format_string(SAME_URL, "url", first_file))
    return found.select(
        *ROW, F.col("id").alias("post_id"), "title", "url",
        reason.alias("reason"), first_file.alias("first_seen_file"),
    )
