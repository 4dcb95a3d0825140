import math
import random
import time
import re
from collections import Counter, defaultdict
from urllib.parse import urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.llm import mixing, queries, topk_search, url_filter

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


# --- urls --------------------------------------------------------------------------------------

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def url_model(rows, links):
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        return re.sub("[A-Z]", lambda m: m[0].lower(), host), path

    def fit(url):
        host, path = parts(url)
        best = None
        for h, p, v in RULES:
            if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
                best = (h + p, v)
        return best or (None, None)

    def key(url):
        if url is None or "://" not in url:
            return url
        host, path = parts(url)
        return (host[4:] if re.match(r"www\.[^.]+\.", host) else host) + path.rstrip("/")

    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None:
            parent[root(key(a))] = root(key(b))
    bad = {root(key(u)) for _, u in rows if u is not None and fit(u)[1] == "block"}
    out = Counter()
    for i, u in rows:
        rule, verdict = fit(u)
        out[i, *parts(u), rule, verdict or ("block" if u is not None and root(key(u)) in bad else "allow")] += 1
    return out


URLS = [
    "http://A.example.ORG/es/x", "https://example.org/en/12?q#f", "https://example.org/en/2", "http://example.org", "http://notexample.org/es/", "http://m.x.com/de/1",
    "http://x.com/fr/de/", "http://x.net/alias", "http://y.net/alias/", "https://www.y.net/alias#a", "http://z.net/far", "http://w.net/free", "no scheme", "",
    None, "http://u@h.net:80/p", "x://", "a://b://c/d", "http://x.com/de/1", "HTTP://É.com/fr/É", "http://com/de/", "http://www.com/de/", "http://h.net\n/x",
]
LINKS = [("http://x.net/alias", "http://m.x.com/de/1"), ("http://y.net/alias", "https://x.net/alias/"), ("http://z.net/far", "http://y.net/alias"),
         ("http://x.com/fr/de/", "http://m.x.com/de/1"), ("http://w.net/free", "http://x.com/fr/de"), ("http://q.net/1", None), (None, "http://m.x.com/de/1")]


@pytest.mark.parametrize("links", [[], LINKS])
def test_urls(spark, links):
    rows = [*enumerate(URLS), (3, URLS[3]), (None, "http://x.com/de/1"), (None, None)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string").repartition(3)
    given = spark.createDataFrame(links, "url string, target string")
    got = url_filter.judge_urls(pages, RULES, given)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == url_model(rows, links)
    assert url_filter.judge_urls(pages.limit(0), RULES, given).collect() == []


def test_long_redirect_chain(spark):
    links = [(f"http://n{i}.net/", f"http://n{i + 1}.net/") for i in range(70)] + [("http://n70.net/", "http://c.com/de/")]
    rows = [(i, f"https://n{i}.net") for i in range(71)] + [(99, "http://c.com/de/")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), RULES, spark.createDataFrame(links, "url string, target string"))
    assert {r.verdict for r in got.collect()} == {"block"}


def test_page_links(spark):
    html = [
        ("http://a.net/x", '<LINK href="http://b.net/y" rel="canonical"><meta http-equiv="refresh" content="0; URL=/z">'),
        ("https://a.net/q", "<link rel=canonical href=//c.net/k><link rel=stylesheet href=/s.css>"),
        ("http://a.net/r", "<meta content='5;url=other.html' http-equiv='refresh'>"), ("http://a.net/n", None), (None, "<link rel=canonical href=http://d.net/>"),
    ]
    got = url_filter.page_links(spark.createDataFrame(html, "url string, html string"))
    assert Counter(map(tuple, got.collect())) == Counter([
        ("http://a.net/x", "http://b.net/y"), ("http://a.net/x", "http://a.net/z"), ("https://a.net/q", "https://c.net/k"), (None, "http://d.net/")])


RELATIVE = ["other.html", "de/index.html", "../de/x", "./", "..", "../../../y?q=../z", "?q#f", "#f", "a/./b/../c#..", "/a/../../b", "//o.net/k", "%2E%2e/x",
            "x?u=http://y.net/", "http://d.net/", ".a/..b/...", "mailto:me"]


@pytest.mark.parametrize("base", ["http://x.com/", "http://x.com", "https://a.net:8/p/q/r.html?k=/l/#m", "http://x.com/a?b/c"])
def test_relative_links(spark, base):
    rows = [(base, f'<meta http-equiv="refresh" content="0; url={target}">') for target in RELATIVE]
    rows += [(base, '<base href="/de/"><link rel=canonical href=x>'), (None, "<link rel=canonical href=x>"), ("no scheme", "<link rel=canonical href=x>")]
    got = url_filter.page_links(spark.createDataFrame(rows, "url string, html string"), relative=True)
    want = [urljoin(base, target.replace("%2E%2e", "..")) for target in RELATIVE[:-1]] + [urljoin(urljoin(base, "/de/"), "x")]
    assert Counter(map(tuple, got.collect())) == Counter((base, target) for target in want)


def test_relative_alias_is_blocked(spark, tmp_path):
    rows = [(1, "http://x.com/", "<meta http-equiv=refresh content='0;url=de/index.html'>"), (2, "http://x.com/de/index.html", ""), (3, "http://x.com/fr", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: r.verdict for r in queries.op4_url_filter(spark, str(tmp_path)).collect()} == {1: "block", 2: "block", 3: "allow"}


# --- mixing ------------------------------------------------------------------------------------

def target_model(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, list(names), share * sum(sizes.values())
    while open_:
        part = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = [s for s in open_ if part[s] > limit * sizes[s]]
        if not full:
            return target | part
        for s in full:
            target[s] = limit * sizes[s]
        left -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return target


def test_word_counts(spark):
    texts = ["", " ", "a", " a  b\t\n c\x0b\x0c\rd ", "é\u00a0x y", None, "\x1c \x1f", "x" * 1000]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.count_words(F.col("text"))).collect()
    assert [r[0] for r in got] == [len(SPLIT.findall(t or "")) for t in texts]


@pytest.mark.parametrize("block", [4, 128])
def test_mix(spark, block):
    pick = random.Random(4)
    rows = [(i, None if i % 97 == 0 else " ".join("w" * pick.randint(1, 3) for _ in range(pick.choice([1, 5, 30, 200]))), pick.choice(["é", "a", "b", None, "z", "Z", ""]))
            for i in range(1500)]
    rows += [(i, "one two three", "a") for i in (2000, 2000, None)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, size int").repartition(6)
    got = mixing.mix_sources(docs, block=block).collect()
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(SPLIT.findall(text or ""))
    want = target_model(size)
    source_of = {i: s for i, _, s in rows}
    taken = Counter()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == size[s] and math.isclose(r.target, want[s])
        assert r.taken in (0, r.size, 2 * r.size) and r.copies in (0, 1, 2)
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 200 for s in size)
    again = mixing.mix_sources(docs.repartition(2), block=block).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_chances_are_kept(spark):
    """Over some seeds documents are taken about as often as their rate says, and never beside it."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(24)], "doc_id long, text string, source string")
    total = Counter()
    rate = {}
    seeds = 8
    for seed in range(seeds):
        for r in mixing.mix_sources(docs, seed=seed, block=5).collect():
            total[r.doc_id] += r.copies
            rate[r.doc_id] = r.target / r.source_size
    assert abs(sum(total[i] - seeds * rate[i] for i in rate)) <= seeds * 3
    assert all(math.floor(rate[i]) * seeds <= total[i] <= math.ceil(rate[i]) * seeds for i in rate)


def test_many_rows_alike(spark):
    """100,000 rows that nothing tells apart, and one more: each is a unit of its own, and targets are met."""
    docs = spark.range(100_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'one two three' AS text", "'a' AS source").unionByName(
        spark.createDataFrame([(5, "x", "b")], "doc_id long, text string, source string"))
    started = time.monotonic()
    got = mixing.mix_sources(docs).groupBy("doc_id", "copies").count().collect()
    assert time.monotonic() - started < 60
    taken = sum(r.copies * r["count"] for r in got if r.doc_id is None)
    assert sum(r["count"] for r in got if r.doc_id is None) == 100_000
    assert abs(3 * taken - target_model({"a": 300_000, "b": 1})["a"]) <= 3


def test_mix_odd_tables(spark):
    kind = "doc_id long, text string, source string"
    assert mixing.mix_sources(spark.createDataFrame([], kind)).collect() == []
    got = mixing.mix_sources(spark.createDataFrame([(1, None, "a"), (2, "", None), (3, "x", "a")], kind)).collect()
    assert {r.doc_id: (r.size, r.source_size) for r in got} == {1: (0, 1), 2: (0, 0), 3: (1, 1)}
    assert all(r.taken <= 2 * r.size for r in got)


# --- search ------------------------------------------------------------------------------------

def search_model(rows, k, every):
    vectors = []
    for i, v in rows:
        if i is not None and v is not None and not any(x is None or not math.isfinite(x) for x in v):
            vectors.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = Counter()
    for q, a in vectors:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in vectors if i != q and len(a) == len(b))
            for rank, (score, i) in enumerate(scores[:k], 1):
                out[q, rank, i, -score] += 1
    return out


@pytest.mark.parametrize(("block", "pivots"), [(4096, 24), (30, 3), (30, 0)])
def test_top_k(spark, block, pivots):
    pick = random.Random(8)
    centres = [[pick.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + pick.gauss(0, 0.1) for c in pick.choice(centres)]) for i in range(300)]
    rows += [(400 + i, [0.5] * 6) for i in range(40)]  # ties
    rows += [(1000, None), (1010, [None] + [0.0] * 5), (1020, [math.nan] * 6), (1030, [math.inf] * 6), (1040, []), (1050, []), (1060, [1.0, 2.0]), (None, [1.0] * 6), (-20, [1.0] * 6)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(4)
    got = topk_search.top_k(df, 5, 10, pivots, block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == search_model(rows, 5, 10)
    assert topk_search.top_k(df.limit(0)).collect() == []


def test_copies_of_blocks_never_go_through_the_driver(spark, monkeypatch):
    """Each block of queries is copied for each of candidates, which Spark's size of a plan does not tell."""
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 1, (400, 5)))]
    plans = []
    real = topk_search.stage

    def staged(df, name):
        out = real(df, name)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(topk_search, "stage", staged)
    got = topk_search.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 5, 2, 4, 20)
    assert Counter(map(tuple, got.collect())) == search_model(rows, 5, 2)
    assert sum("Join" in plan for plan in plans) == topk_search.WAVES
    assert not [plan for plan in plans if "BroadcastExchange" in plan]


def test_blocks_travel_in_narrow_integers():
    for top, width in ((2**15 - 1, 2), (2**15, 4), (2**31, 8)):
        x = np.array([[top, -5], [0, -top]], np.int64)
        data = topk_search.narrow(x).tobytes()
        assert len(data) == 4 * width
        assert topk_search.widened(data, 2, 2).tolist() == x.tolist()
    assert topk_search.widened(topk_search.narrow(np.zeros((3, 0), np.int64)).tobytes(), 3, 0).shape == (3, 0)


@pytest.mark.parametrize("spread", [1, 2000])
def test_floors_leave_out_only_what_is_below(spread):
    """Both where bounds rule out little (one cloud) and where they rule out most (clouds far apart)."""
    rng = np.random.default_rng(2)
    x = (rng.integers(0, 9, (1500, 1)) * spread + rng.integers(-9, 10, (1500, 6))).astype(np.int64)
    far = topk_search.distances(x, x[:8])
    ids = np.arange(1500) // 2
    scores = x[:40] @ x.T
    floors = {i: int(np.sort(scores[2 * i])[-9]) for i in range(0, 20, 2)}
    got = topk_search.search_block(ids[:40:2], x[:40:2], far[:40:2], ids, x, far, 5, floors)
    want = []
    for i in range(20):
        order = [j for j in np.lexsort((ids, -scores[2 * i])) if ids[j] != i and scores[2 * i, j] >= floors.get(i, -np.inf)][:5]
        want += [(i, int(ids[j]), int(scores[2 * i, j])) for j in order]
    assert got == want


def test_bounds_stop_the_search(monkeypatch):
    """Near vectors come first, so most candidates are never evaluated; the result stays exact."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 4000, (40, 16))
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 20, (4000, 16))).astype(np.int64)
    x = (x * (4000 / np.linalg.norm(x, axis=1))[:, None]).astype(np.int64)
    seen = []
    real = np.lexsort

    def counted(keys):
        seen.append(len(keys[0]))
        return real(keys)

    monkeypatch.setattr(topk_search.np, "lexsort", counted)
    far = topk_search.distances(x, x[:24])
    ids = np.arange(len(x))
    got = topk_search.search_block(ids[:20], x[:20], far[:20], ids, x, far, 5)
    monkeypatch.undo()
    want = []
    for i in range(20):
        scores = x @ x[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:5]
        want += [(i, int(j), int(scores[j])) for j in order]
    assert got == want
    assert len(seen) < 20 * 5
