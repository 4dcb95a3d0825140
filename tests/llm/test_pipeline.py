"""The stages of the corpus pipeline against plain Python, on null labels, repeats and extra columns."""

import random
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from quillmill.llm.mixing import mix_sources

KIND = "doc_id long, text string, lang string, source string, copies int, `its score` string"


def some_rows():
    pick = random.Random(1)
    rows = []
    for i in range(12):
        words = [f"w{chr(97 + i)}{chr(97 + pick.randrange(26))}{chr(97 + pick.randrange(26))}" for _ in range(120)]
        rows.append((i, " ".join(words), None, "ab"[i % 2], i, "x"))
    near = rows[3][1].split(" ")
    rows.append((20, " ".join([*near[:-1], "other"]), None, "a", 1, None))
    rows += [(30, rows[5][1], None, "b", 1, "y"), rows[6], rows[6]]
    return rows + [(40, None, None, "a", 1, "x"), (41, "", None, "a", 1, "x"), (42, "12 -- 3", None, None, 1, "x"), (43, "語", None, None, 1, "x")]


def table(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3)


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


def lettered(rows):
    return [r for r in rows if any(c.isalpha() for c in r[1] or "")]


def one_of_each_text(rows):
    best = {}
    for r in rows:
        if r[1] not in best or r[0] > best[r[1]][0]:
            best[r[1]] = r
    return list(best.values())


@pytest.mark.parametrize("label", [None, "und"])
def test_language_id_keeps_letters_without_labels(spark, label):
    rows = [(*r[:2], label, *r[3:]) for r in some_rows()]
    assert rows_of(pipeline.language_id(spark, table(spark, rows), "")) == Counter(lettered(rows))


def test_language_id_with_labels(spark):
    rows = [(*r[:2], "aa" if r[0] < 5 else None, *r[3:]) for r in some_rows()]
    assert rows_of(pipeline.language_id(spark, table(spark, rows), "")) == Counter(lettered(rows))


def test_dedup_stages(spark):
    rows = lettered(some_rows())
    unique = one_of_each_text(rows)
    assert rows_of(pipeline.exact_dedup(spark, table(spark, rows), "")) == Counter(unique)
    assert rows_of(pipeline.near_dedup(spark, table(spark, unique), "")) == Counter(r for r in unique if r[0] != 20)


def test_mix(spark):
    rows = [r for r in one_of_each_text(lettered(some_rows())) if r[0] != 20]
    docs = table(spark, rows)
    copies = {r.doc_id: r.copies for r in mix_sources(docs).collect()}
    want = Counter({r: copies[r[0]] for r in rows if copies[r[0]]})
    assert rows_of(pipeline.mix(spark, docs, "")) == want


def test_mix_counts_rows_that_share_an_id(spark):
    rows = [(1 if i % 2 else None, "w " * 10, None, "a", i, "x") for i in range(300)] + [(900, "w " * 3000, None, "b", 1, "x")]
    got = pipeline.mix(spark, table(spark, rows), "").collect()
    words = sum(10 for r in got if r.source == "a")
    want = {r.target for r in mix_sources(table(spark, rows)).collect() if r.doc_id != 900}.pop()
    assert abs(words - want) <= 10 and {tuple(r) for r in got} <= {tuple(r) for r in rows}


def test_run_without_labels(spark, tmp_path):
    rows = some_rows()
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    left = [r for r in one_of_each_text(lettered(rows)) if r[0] != 20]
    copies = {r.doc_id: r.copies for r in mix_sources(table(spark, left)).collect()}
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == Counter({i: n for i, n in copies.items() if n})
    assert all(len(r.ids) == r.n_tokens > 0 for r in got)


def test_empty_tables(spark):
    for name, step in pipeline.STAGES:
        assert step(spark, table(spark, []), "").collect() == [], name
