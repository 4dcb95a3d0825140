import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, strategies as st

from quillmill.llm import exact_dedup, near_dedup, substring_dedup, words
from quillmill.llm.common import connected_components

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


@given(st.lists(st.text(alphabet=" \t\u000b aBé日", max_size=80), max_size=8))
def test_hash_words(texts):
    hashes, offsets = words.hash_words([t.encode() for t in texts])
    found = [SPLIT.findall(t) for t in texts]
    assert np.diff(offsets).tolist() == [len(f) for f in found]
    flat = [w for f in found for w in f]
    assert len(set(flat)) == len({(w, h) for w, h in zip(flat, hashes.tolist(), strict=True)}) == len(set(hashes.tolist()))


def test_pieces_cut_between_texts(monkeypatch):
    monkeypatch.setattr(words, "PIECE_BYTES", 5)
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "de", "f", "0123456789", "g"])], ["text"])
    got = list(words.pieces(batch))
    assert [start for start, _ in got] == [0, 3, 4, 5]
    assert [t for _, group in got for t in group] == [b"abc", b"", b"de", b"f", b"0123456789", b"g"]


@given(st.dictionaries(st.integers(0, 2**64 - 1), st.integers(1, 2**40), min_size=1, max_size=60), st.integers(0, 9))
def test_filter_round_trip_and_merge(values, bits):
    keys = np.array(sorted(values), np.uint64)
    counts = np.array([values[int(k)] for k in keys], np.uint64)
    block = exact_dedup.pack_filter(keys, counts, bits)
    back = exact_dedup.unpack_filter(block)
    assert back[0].tolist() == keys.tolist() and back[1].tolist() == counts.tolist()
    other = exact_dedup.pack_filter(keys[::2], counts[::2], 3)
    merged = exact_dedup.merge_filters([block, other])
    want = Counter(values)
    want.update({int(k): values[int(k)] for k in keys[::2]})
    assert dict(zip(merged[0].tolist(), merged[1].tolist(), strict=True)) == dict(want)


def exact_model(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = Counter()
    for i, text in rows:
        ids = groups[text or ""]
        known = [x for x in ids if x is not None]
        keep = max(known) if known else None
        out[i, keep, len(ids), i == keep, sha(text)] += 1
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_exact(docs, texts, monkeypatch, block):
    monkeypatch.setattr(exact_dedup, "BLOCK_FINGERPRINTS", block)
    got = exact_dedup.exact_duplicates(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == exact_model([*texts, texts[3]])
    left = exact_dedup.keep_documents(docs, got)
    assert left.columns == docs.columns
    assert sorted((r.text or "") for r in left.collect()) == sorted({t or "" for _, t in texts})


def test_exact_odd_tables(nothing, null_ids):
    assert exact_dedup.exact_duplicates(nothing).collect() == []
    rows = [tuple(r) for r in null_ids.collect()]
    got = exact_dedup.exact_duplicates(null_ids)
    assert Counter(map(tuple, got.collect())) == exact_model(rows)
    assert sorted((r.text or "") for r in exact_dedup.keep_documents(null_ids, got).collect()) == ["", "a b c d e f", "only here"]


def near_model(rows, percent):
    sets = []
    for _, text in rows:
        w = SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            met = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * met >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return Counter((rows[i][0], len(sets[i]), least[root(i)], rows[i][0] == least[root(i)]) for i in range(len(rows)))


@pytest.mark.parametrize(("percent", "limit"), [(85, 1000), (80, 2)])
def test_near(docs, texts, percent, limit):
    got = near_dedup.near_duplicates(docs, percent, bucket_limit=limit)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == near_model([*texts, texts[3]], percent)


def test_near_family_whose_centre_is_unlike_the_others(spark):
    """Copies of one text with edits in places of their own: each is like the text, not like the others."""
    base = [f"b{i}" for i in range(300)]
    rows = []
    for i in range(40):
        one = list(base)
        for k in range(5):
            one[(i * 7 + k * 60) % 300] = f"e{i}-{k}"
        rows.append((i, " ".join(one)))
    rows.append((99, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, near_dedup.near_duplicates(docs).collect())) == near_model(rows, 85)


@pytest.mark.parametrize("order", range(4))
def test_near_rows_of_one_id_are_one_document(spark, order):
    one, two = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(5, " ".join(one)), (5, " ".join(two)), (7, " ".join([*one[:-1], "x"])), (9, " ".join([*two[:-1], "x"])), (8, "other words here"), (5, None),
            (11, " ".join(one)), (12, "lone text"), (12, "another lone text")]
    random.Random(order).shuffle(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 5), (7, 5), (9, 5), (11, 5), (8, 8), (12, 12)}
    assert len(got) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_links_at_the_limit_are_found(spark):
    """A few thousand documents, of which links lie between 80 and 90 %: none is lost or made up."""
    pick = random.Random(12)
    rows = []
    for family in range(300):
        base = [f"f{family}w{pick.randrange(10**6)}" for _ in range(pick.randint(40, 160))]
        for copy in range(8):
            words = list(base)
            for _ in range(pick.randint(0, max(1, len(words) // 60))):
                words[pick.randrange(len(words))] = f"e{pick.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    want = Counter()
    for family in range(300):
        want += near_model(rows[8 * family : 8 * family + 8], 85)
    assert Counter(map(tuple, got)) == want


def test_near_odd_tables(nothing, null_ids):
    assert near_dedup.near_duplicates(nothing).collect() == []
    got = sorted(map(tuple, near_dedup.near_duplicates(null_ids).collect()), key=repr)
    assert got == sorted([(None, 2, None, True), (None, 2, None, True), (None, 0, None, True), (4, 2, 4, True), (None, 1, None, True)], key=repr)


def test_band_shape():
    for percent in (80, 85):
        for level in range(3):
            bands, rows = near_dedup.band_shape(percent, level)
            assert (1 - (percent / 100) ** rows) ** bands <= 1e-6
    assert near_dedup.band_shape(80, 0)[1] == 4


def passage_model(rows, window):
    split = [SPLIT.findall(text or "") for _, text in rows]
    first = {}
    for (i, _), w in zip(rows, split, strict=True):
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    out = Counter()
    for (i, _), w in zip(rows, split, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


@pytest.mark.parametrize(("window", "gram"), [(13, 5), (6, 5), (4, 4)])
def test_passages(docs, texts, window, gram, monkeypatch):
    monkeypatch.setattr(words, "PIECE_BYTES", 3000)
    got = substring_dedup.repeated_passages(docs, window, gram)
    rows = [*texts, texts[3]]
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == passage_model(rows, window)


def test_passages_odd_tables(nothing, null_ids):
    assert substring_dedup.repeated_passages(nothing).collect() == []
    got = substring_dedup.repeated_passages(null_ids, digest=True).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == Counter(
        (i, len((t or "").split()), 0, sha(" ".join((t or "").split()))) for i, t in map(tuple, null_ids.collect()))


def test_passages_of_one_id(spark):
    """Rows with one doc_id are not each other's reference, but those after them see both."""
    w = [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(w[:30])), (1, " ".join(w[10:50])), (2, " ".join(w))]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == passage_model(rows, 13)


@given(st.lists(st.integers(0, 50), min_size=9, max_size=40))
def test_anchors(values):
    found = substring_dedup.anchors(np.array(values, np.uint64), 9)
    assert found.tolist() == [min(values[i : i + 9]) for i in range(len(values) - 8)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(200, 200), (150, 300), (7, 7)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 160), 300]}
