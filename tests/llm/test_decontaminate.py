"""Benchmark passages in documents, against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quillmill.llm import decontaminate
from quillmill.llm.decontaminate import Automaton, cut_spans, find_items, hit_words, spans_of
from quillmill.llm.queries import op11_decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def windows(text, n):
    words = WORD.findall(lowered(text))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def model(text, items, n):
    """Words, hit words and ids of the items found, window by window."""
    words, hit, found = WORD.findall(lowered(text)), set(), set()
    for item, passage in items:
        for window in windows(passage, n):
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
    return len(words), hit, sorted(str(i) for i in found if i is not None)


def some_tables():
    pick = random.Random(4)
    words = ["a", "B", "é", "日本", "x1", "Zz", "of", "12"]
    make = lambda n: pick.choice([" ", ", ", "\n", "--"]).join(pick.choice(words) for _ in range(n))
    items = [(i, make(pick.randint(1, 9))) for i in range(12)] + [(3, make(4)), (None, make(3)), (90, None), (91, ""), (92, "?!"), (5, "no such words here"), (93, items_text := make(40)), (94, items_text)]
    docs = [(i, make(pick.randint(0, 60))) for i in range(60)]
    docs += [(7, "a B é 日本"), (None, items_text.upper()), (70, None), (71, ""), (72, "..."), (73, "Ü " + items_text + " tail"), (73, "Ü " + items_text + " tail")]
    return items, docs


@pytest.mark.parametrize("n", [3, 10])
@pytest.mark.parametrize("shard_bytes", [2**20, 300])
def test_against_plain_python(spark, n, shard_bytes):
    items, docs = some_tables()
    given = spark.createDataFrame([(*row, 1, "x") for row in docs], "doc_id long, text string, shard int, n_words string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_items(given, bench, n=n, shard_bytes=shard_bytes).withColumn("n_hit", hit_words(F.col("spans"))).collect()
    seen = sorted(((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str)
    want = []
    for doc_id, text in docs:
        n_words, hit, found = model(text, items, n)
        want.append((doc_id is None, doc_id, n_words, len(hit), found))
    assert seen == sorted(want, key=str)
    for row in got:
        for one, two in zip(row.spans, row.spans[1:]):
            assert one["last"] + 1 < two["first"]


def test_offsets_are_those_of_the_given_text(spark):
    text = "Ünder\tthe -- GREEN  tree. é"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([("q", "nothing", "the green TREE")], "item_id string, question string, answer string")
    found = find_items(docs, bench, ["question", "answer"])
    row = found.first()
    assert [text[s.start : s.stop] for s in row.spans] == ["the -- GREEN  tree"] and row["items"] == ["q"]
    assert found.join(docs, "doc_id").select(cut_spans(F.col("text"), F.col("spans"))).first()[0] == "Ünder\t. é"


def test_long_texts_are_scanned_in_pieces(monkeypatch):
    pick = random.Random(2)
    words = [pick.choice("abcd") for _ in range(3000)]
    text = " ".join(words).encode()
    pieces = [("i", [w.encode() for w in words[1000:1004]]), ("j", [b"a", b"b"]), ("k", [b"d"] * 6)]
    whole = Automaton(pieces, 10).scan(text)
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", 7)
    assert Automaton(pieces, 10).scan(text) == whole
    assert whole[0] == 3000 and spans_of(text, whole[1])[0]["start"] >= 0


def test_long_items_are_cut_with_an_overlap(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 4)
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(2, 27))), (2, "w1 w2 w3")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: [(s.first, s["last"]) for s in r.spans] for r in find_items(docs, bench, n=5).collect()}
    assert got == {1: [(0, 24)], 2: []}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert find_items(docs.limit(0), bench).collect() == []
    assert find_items(docs, bench.limit(0)).first()["items"] == []
    assert find_items(docs, bench.select("item_id", F.lit(None).cast("string").alias("text"))).first().n_words == 2


def test_query(spark, tmp_path):
    items, docs = some_tables()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, op11_decontaminate(spark, str(tmp_path)).collect()), key=str)
    want = []
    for doc_id, text in docs:
        n_words, hit, found = model(text, items, 10)
        want.append((doc_id, n_words, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    assert got == sorted(want, key=str)
