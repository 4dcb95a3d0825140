"""Dedup and naming against plain sequential models."""

import os
import random

import pytest

from quillmill.operators.dedup import duplicate_posts, kept_posts
from quillmill.operators.names import file_names
from quillmill.operators.skew import keyed_join, running_total, spread_rows

POSTS = "feed_path STRING, entry_index BIGINT, id STRING, title STRING, url STRING"


def model_kept(rows):
    ids, urls, kept = set(), set(), []
    for feed, at, post_id, _, url in sorted(rows, key=lambda r: r[:2]):
        if (feed, post_id) in ids or (url and (feed, url) in urls):
            continue
        ids.add((feed, post_id))
        if url:
            urls.add((feed, url))
        kept.append((feed, at))
    return kept


def model_names(rows):
    used, names = set(), {}
    for feed, at, base in sorted(rows):
        name, number = base, 2
        while (feed, name) in used:
            name, number = f"{base}-{number}", number + 1
        used.add((feed, name))
        names[feed, at] = f"{name}.md"
    return names


@pytest.mark.parametrize("options", [
    dict(), dict(rounds=100), dict(rounds=100, floor=0), dict(rounds=1, floor=5), dict(rounds=0), dict(rounds=0, floor=0)])
def test_kept_posts(spark, options):
    r = random.Random(str(options))
    rows = [
        (f"f{n % 2}", n // 2 + 1, f"id{r.randrange(90)}", "t", r.choice([None, ""] + [f"u{r.randrange(90)}" for _ in range(6)]))
        for n in range(500)]
    # A hot id with many URLs, and a hot URL with many ids.
    rows += [("f0", 1000 + n, "id1", "t", f"v{n}") for n in range(100)] + [("f0", 2000 + n, f"j{n}", "t", "u1") for n in range(100)]
    kept = kept_posts(spark.createDataFrame(rows, POSTS), **options)
    assert sorted((k.feed_path, k.entry_index) for k in kept.collect()) == model_kept(rows)


@pytest.mark.parametrize("rounds", [2, 100])
def test_kept_posts_of_a_long_chain(spark, rounds):
    rows = []
    for n in range(12):
        rows += [("f", 2 * n + 1, f"i{n}", "t", f"u{n}"), ("f", 2 * n + 2, f"i{n + 1}", "t", f"u{n}")]
    kept = kept_posts(spark.createDataFrame(rows, POSTS), rounds=rounds)
    assert sorted((k.feed_path, k.entry_index) for k in kept.collect()) == model_kept(rows)


def test_no_posts(spark):
    empty = spark.createDataFrame([], POSTS)
    assert kept_posts(empty).collect() == []
    assert file_names(empty.selectExpr("feed_path", "entry_index", "title AS base")).collect() == []


@pytest.mark.parametrize("floor", [None, 0])
def test_duplicates_name_an_earlier_post(spark, floor):
    rows = [("f", 1, "a", "t", "u"), ("f", 2, "b", "t", "u"), ("f", 3, "b", "t", "v"), ("f", 4, "a", "t", "v"), ("f", 5, "b", "t", None)]
    posts = spark.createDataFrame(rows, POSTS)
    kept = kept_posts(posts).selectExpr("*", "concat(id, '.md') AS file_name")
    found = {d.entry_index: d.reason for d in duplicate_posts(posts, kept, 10, floor=floor).collect()}
    assert found == {
        # Post 3 holds id b, but only later than post 2.
        2: "Duplicate canonical URL encountered: 'u' (already seen as 'a.md')",
        4: "Duplicate post ID encountered: 'a' (already seen as 'a.md')",
        5: "Duplicate post ID encountered: 'b' (already seen as 'b.md')"}


@pytest.mark.parametrize("options", [
    dict(), dict(family_rows=0), dict(family_rows=0, floor=0, width=7), dict(floor=10, width=40), dict(family_rows=6, floor=0, width=9)])
def test_file_names(spark, options):
    r = random.Random(str(options))

    def base():
        text = r.choice(["d-x", "d-y", "d-"])
        while r.random() < 0.45:
            text += f"-{r.choice([1, 2, 2, 2, 3, 3, 4, 5, 7, 12, 40])}"
        return text

    rows = [(f"f{n % 2}", n // 2 + 1, base()) for n in range(400)]
    rows += [("f0", 500 + n, "d-0007"[: r.choice([3, 6])]) for n in range(40)] + [("f0", 600, "d-x-99999999999999999999")]
    named = file_names(spark.createDataFrame(rows, "feed_path STRING, entry_index BIGINT, base STRING"), **options)
    assert {(n.feed_path, n.entry_index): n.file_name for n in named.collect()} == model_names(rows)


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_keyed_join_with_hot_and_null_keys(spark, how):
    r = random.Random(how)
    rows = [(n, r.choice(["hot"] * 5 + [None, "a", "b", "c", "z"])) for n in range(300)]
    left = spark.createDataFrame(rows, "n INT, k STRING")
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("q", 3)], "k STRING, v INT")
    got = keyed_join(left, right, ["k"], how, 300, floor=50)
    plain = left.join(right, "k", how)
    assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_running_total(spark):
    r = random.Random(1)
    rows = [(r.choice("ab"), n, r.randrange(5)) for n in r.sample(range(1000), 200)]
    got = running_total(spark.createDataFrame(rows, "k STRING, at BIGINT, v INT"), ["k"], "at", "v", "total", width=16)
    sums, want = {"a": 0, "b": 0}, {}
    for key, at, value in sorted(rows, key=lambda row: row[1]):
        sums[key] += value
        want[key, at] = sums[key]
    assert {(g.k, g.at): g.total for g in got.collect()} == want


def test_small_groups_are_spread_over_tasks(spark):
    rows = spark.createDataFrame([(f"f{n % 40}", f"b{n % 3}") for n in range(400)], "feed_path STRING, family STRING")
    count = lambda group: group[:1].assign(task=os.getpid(), rows=len(group))
    found = spread_rows(rows, "feed_path", "family").groupBy("feed_path", "family").applyInPandas(
        count, "feed_path STRING, family STRING, task LONG, rows LONG")
    assert found.rdd.getNumPartitions() >= 8
    assert found.count() == 120 and sum(row.rows for row in found.collect()) == 400
