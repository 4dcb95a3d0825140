import json

import pytest
from pyspark.sql import functions as F

from quillmill.functions import text
from quillmill.operators.documents import document_text, frontmatter_struct, frontmatter_text


def values(spark, build, *inputs):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(inputs)], "n INT, v STRING")
    return [r.out for r in df.select("n", build(F.col("v")).alias("out")).orderBy("n").collect()]


def test_strip(spark):
    odd = ["  a b\t\n", "   x ", "\x1cx\x1f", "", "a"]
    assert values(spark, text.strip, *odd) == [v.strip() for v in odd]


def test_capitalized(spark):
    odd = ["custom_widget", "aBC dEF", "", "é x"]
    assert values(spark, text.capitalized, *odd) == [v.capitalize() for v in odd]


def test_slug(spark):
    assert values(spark, text.slug, "Hello, World!", "Déjà  vu -- été", "日本", "", "---", "a_b - c", "x" * 59 + " yz", " -lead", "ﬁn ½") == [
        "hello-world", "deja-vu-ete", "post", "post", "", "a_b-c", "x" * 59, "-lead", "fin-12"]


def test_date_prefix(spark):
    assert values(spark, text.date_prefix, " 2024-03-02T08:00Z ", "2024-99-99", "2024/03/02x", "", "2024-03-0", "²024-01-01", "٢٠٢٤-01-01z") == [
        "2024-03-02", "2024-99-99", "undated", "undated", "undated", "²024-01-01", "٢٠٢٤-01-01"]


def test_postprocess(spark):
    source = "\r\n a&amp;amp; b&nbsp; \n \t \n\n\n```py\nx &lt; y  \n\n\n\n z```\rend &copy ```&gt; "
    assert values(spark, text.postprocess_markdown, source) == ["a&amp; b\n\n```py\nx &lt; y\n\n z```\nend © ```>"]
    assert values(spark, text.postprocess_markdown, "a\x0b \n b") == ["a\n b"]


def front(spark, extra=None, **fields):
    row = dict(title="T", published="2024", url=None, labels=[], id="i", updated=None, author_name=None) | fields
    schema = "title STRING, published STRING, url STRING, labels ARRAY<STRING>, id STRING, updated STRING, author_name STRING"
    df = spark.createDataFrame([tuple(row.values())], schema)
    if callable(extra):
        extra = extra()
    return df.select(frontmatter_text(extra=extra)).first()[0]


def parse(block):
    """Plain keys with JSON values, and one list: all that the frontmatter uses of YAML."""
    lines = block.removeprefix("---\n").removesuffix("\n---\n").split("\n")
    data = {}
    for line in lines:
        if line.startswith("- "):
            data["labels"].append(json.loads(line[2:]))
        else:
            key, _, value = line.partition(":")
            data[json.loads(key) if key.startswith('"') else key] = json.loads(value) if value else []
    return data


@pytest.mark.parametrize("title", ["plain", 'a: "b" # c', "- x", "null", "tab\tnew\nline", "é \x85\x7f", "back\\slash", "'"])
def test_frontmatter_round_trip(spark, title):
    block = front(spark, title=title, labels=["a: b", title], updated="", author_name="Ann")
    assert parse(block) == {
        "title": title, "date": "2024", "url": "", "labels": ["a: b", title], "classification": "personal_analysis",
        "type": "personal_analysis", "id": "i", "author": "Ann"}
    assert not set(block) & set(" \x85\x7f")


def test_frontmatter_extra(spark):
    assert list(parse(front(spark, {"type": "note", "stars": 3, "updated": "now"})).items())[5:] == [
        ("type", "note"), ("id", "i"), ("updated", "now"), ("stars", 3)]
    by_column = parse(front(spark, lambda: F.create_map(F.lit("type"), F.lit("note"), F.lit("more"), F.lit("x"))))
    assert by_column["type"] == "note" and list(by_column)[-1] == "more" and by_column["labels"] == []


def test_document_text(spark):
    df = spark.createDataFrame([("---\nx\n---\n", " body \n"), ("---\nx\n---\n", " \n"), ("---\nx\n---\n", None)], "f STRING, m STRING")
    assert [r[0] for r in df.select(document_text(F.col("f"), F.col("m"))).collect()] == [
        "---\nx\n---\n\nbody\n", "---\nx\n---\n\n", "---\nx\n---\n\n"]


def test_frontmatter_struct(spark):
    df = spark.createDataFrame(
        [("T", "2024", None, None, "i", "", "Ann")],
        "title STRING, published STRING, url STRING, labels ARRAY<STRING>, id STRING, updated STRING, author_name STRING")
    assert df.select(frontmatter_struct("note").alias("f")).first().f.asDict() == {
        "title": "T", "date": "2024", "url": "", "labels": [], "classification": "note", "type": "note", "id": "i",
        "updated": None, "author": "Ann"}
