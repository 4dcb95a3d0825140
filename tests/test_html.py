"""Markdown goldens, and the node extractors against the same snippets."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillmill.functions import text
from quillmill.functions.markup import read_nodes
from quillmill.operators import nodes
from quillmill.operators.markdown import conversion_issues, html_to_markdown

GOLDENS = {
    "blank": (" \n ", ""),
    "inline": ("<p>A <strong>b</strong> and <em> c </em> at <a href='/x' title='t\"'>d</a>.</p>", 'A **b** and  *c*  at [d](/x "t\\"").'),
    "autolink": ('<a href="http://x">http://x</a> <a>no</a> <a href="y"> </a>', "<http://x> no"),
    "headings": ("<h1>A\n <b>b</b></h1><h6>c</h6><p>d</p>", "# A **b**\n\n###### c\n\nd"),
    "lists": (
        "<ul><li>a<ol start='3'><li>b</li><li>c<ul><li>d</li></ul></li></ol></li><li></li><li>e</li></ul><p>f</p>",
        "- a\n  3. b\n  4. c\n     - d\n- e\n\nf"),
    "quote": ("<blockquote><p>a</p><p>b<br>c</p></blockquote>", "> a\n>\n> b\n> c"),
    "breaks": ("a<br>b<hr>c", "a\nb\n\n---\n\nc"),
    "marks": ("<del>x</del> <s>y</s> <code>a`b</code> <kbd>k</kbd> <q>q</q>", '~~x~~ ~~y~~ `` a`b `` `k` "q"'),
    "stars stay": ("a*b_c 1 < 2 &amp;lt; x", "a*b_c 1 < 2 < x"),
    "sup and sub": ("H<sub> 2 </sub>O<sup> </sup>", "H<sub>2</sub>O"),
    "definitions": ("<dl><dt>t</dt><dd>d<br>e</dd></dl>", "t\n:   d\n    e"),
    "script": ("<p>a</p><script>var x='</p>';</script><style>p{}</style><p>b</p>", "a\n\nb"),
    "header row": ("<table> <thead> <tr><th>A</th><th>B</th></tr> </thead><tbody><tr><td>1</td><td>x<br>y</td></tr></tbody></table>",
                   "| A | B |\n| --- | --- |\n| 1 | x y |"),
    "no header row": ("<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>", "|  |  |\n| --- | --- |\n| 1 | 2 |\n| 3 |"),
    "images in cells": ("<table><tr><th><img src='s' alt='pic'></th></tr></table><img src='s' alt='pic'>",
                        "| pic |\n| --- |\n\n![pic](s)"),
    "merged cells": ("<table border=1><tr><td colspan='2'>a &amp; b</td></tr></table>",
                     '<table border="1"><tr><td colspan="2">a & b</td></tr></table>'),
    "odd spans": ("<table><tr><td rowspan='x'>a</td></tr></table>", '<table><tr><td rowspan="x">a</td></tr></table>'),
    "blocks in cells": ("<table><tr><td><ul><li>a</li></ul></td></tr></table>",
                        "<table><tr><td><ul><li>a</li></ul></td></tr></table>"),
    "spans of one": ("<table><tr><th colspan='1' rowspan=''>a</th></tr></table>", "| a |\n| --- |"),
    "embeds": ('<p>x</p><iframe src="/v?a=1&amp;b=2" allowfullscreen></iframe><p>y</p>',
               'x\n\n<iframe src="/v?a=1&b=2" allowfullscreen=""></iframe>\n\ny'),
    "whole inside": ("<html><head><script>x</script></head><div>a<div><video><p>v</p></video></div>b<pre>c</pre></div>d",
                     "a\n\n<video><p>v</p></video>\n\nb\n\n```\nc\n```\n\nd"),
    "many pieces": ("<div>" + "<p>a <b>b</b></p>\n" * 300 + "</div>", "\n\n".join(["a **b**"] * 300)),
    "details": ("<details>\n <summary>s</summary><pre class='a'><code class='b'>c</code></pre></details>",
                '<details>\n<summary>s</summary><pre class="a b"><code class="b">c</code></pre></details>'),
    "brush": ("<pre class='Brush: PY; x'>\n a\n\n</pre>", "```py\n a\n```"),
    "language": ("<pre><code class='x language-C-Sharp'>a &lt; b</code></pre>", "```c-sharp\na < b\n```"),
    "named language": ("<pre class='x Rust'>a</pre>", "```rust\na\n```"),
    "spacers": ("<p>1</p><div><br /></div><p>&nbsp;</p><div><div><br></div></div><p>2</p>", "1\n\n2"),
    "lifted": ("<h3>T<p>1</p><ul><li><p>2</p></li></ul></h3>z", "### T\n\n2\n\n1\n\nz"),
    "caption": ("<table class='x tr-caption-container y'><tr><td><a href='/f'><img src='/t'></a></td></tr>"
                "<tr><td class='tr-caption'> A <b>b</b> </td></tr></table>", "[![Ab](/t)](/f)\n\n*Ab*"),
    "caption without link": ("<table class='tr-caption-container'><tr><td><a><img src='/t' alt=''></a><a href='/f'>x</a></td></tr></table>", "![](/t)"),
    "caption without image": ("<table class='tr-caption-container'><tr><th>x</th></tr></table>", "| x |\n| --- |"),
    "separator": ("a<div class='separator'><a href='/b'><img src='/s'></a></div>b", "a[![](/s)](/b)b"),
    "big separator": ("a<div class='separator'><p><a href='/b'><img src='/s'></a></p></div>b", "a\n\n[![](/s)](/b)\n\nb"),
    "widgets": ("a<source-footnote> </source-footnote><response-element>b <i>c</i></response-element>", "ab *c*"),
    "comments": ("a <!-- x --> b<!-- y --><p>c<!-- z --></p>", "a b\n\nc"),
    "unclosed": ("<p>a<p>b<b>c</p>d", "a\n\nb**c**\n\nd"),
    "references": ("&copy; &nosuch; &#146; &#x2014; AT&T x", "© &nosuch ’ — AT&T x"),
    "deep": ("<div>" * 3000 + "x", "x"),
}


@pytest.fixture(scope="module")
def converted(spark):
    rows = [(name, html) for name, (html, _) in GOLDENS.items()]
    df = html_to_markdown(spark.createDataFrame(rows, "name STRING, html STRING"), "html")
    return {r.name: r for r in df.collect()}


@pytest.mark.parametrize("name", GOLDENS)
def test_golden(converted, name):
    assert converted[name].error is None
    assert converted[name].markdown == GOLDENS[name][1]


def test_unreadable_html_is_kept(spark):
    bad = "<p>x\r\n<![nonsense z]> "
    try:
        read_nodes(bad)
        pytest.skip("this Python reads it")
    except AssertionError:
        pass
    df = spark.createDataFrame([("f", 1, "i", "t", bad)], "feed_path STRING, entry_index BIGINT, id STRING, title STRING, content_html STRING")
    done = html_to_markdown(df)
    assert done.first().markdown == bad
    issue = conversion_issues(done).first()
    assert (issue.severity, issue.issue_type, issue.post_id) == ("error", "html_conversion_error", "i")
    assert issue.message.startswith("Failed to cleanly convert HTML content: ")


def test_overrides(spark):
    df = spark.createDataFrame([("<u>a</u> <b>c</b> <i>d</i> <video></video> <em>e</em>",)], "html STRING")
    rules = {"u": "preserve", "b": "drop", "video": "drop", "i": "unwrap", "em": lambda node, text, frame: F.concat(F.lit("_"), text, F.lit("_"))}
    assert html_to_markdown(df, "html", overrides=rules).first().markdown == "<u>a</u>\n\n  d  _e_"


def test_reading_and_writing(spark):
    html = '<video class="a  b" q=\'1"2\' r=\'"&apos;\'>x<br/>&lt;&amp;<i/>y<!--c--><script>a<b</script></video>'
    df = nodes.with_nodes(spark.createDataFrame([(1, html)], "id INT, html STRING"))
    assert nodes.embeds(df, ["id"]).first().outer_html == (
        '<video class="a b" q=\'1"2\' r="&quot;\'">x<br/>&lt;&amp;<i></i>y<!--c--><script>a<b</script></video>')


def rows(spark, extractor, html):
    df = nodes.with_nodes(spark.createDataFrame([(1, html), (2, None)], "id INT, html STRING"))
    return [tuple(r)[1:] for r in extractor(df, ["id"]).orderBy("id", *extractor(df, ["id"]).columns[1:2]).collect()]


def test_nodes(spark):
    df = spark.createDataFrame([("a<p x=1>b<i>c</i></p><!--d-->",)], "html STRING")
    assert [tuple(r) for r in nodes.html_nodes(df, []).collect()] == [
        (0, 0, -1, 1, "text", "", {}, "a"), (1, 4, -1, 1, "element", "p", {"x": "1"}, ""),
        (2, 2, 1, 2, "text", "", {}, "b"), (3, 4, 1, 2, "element", "i", {}, ""), (4, 4, 3, 3, "text", "", {}, "c"),
        (5, 5, -1, 1, "comment", "", {}, "d")]


@pytest.mark.parametrize("extractor, html, expected", [
    (nodes.links, "<a href='/x'>a<b>c</b></a><a>n</a>", [(0, "/x", "ac")]),
    (nodes.images, "<a href='/x'><a href='/y'><img src=s></a></a><img alt=q>", [(2, "s", "", "/y"), (3, "", "q", None)]),
    (nodes.headings, "<h2> a <i>b</i>\n</h2>", [(0, 2, "a b")]),
    (nodes.captions, GOLDENS["caption"][0], [(0, "/t", "/f", "Ab", "Ab")]),
    (nodes.captions, GOLDENS["caption without link"][0], [(0, "/t", None, "", "")]),
    (nodes.captions, GOLDENS["caption without image"][0], []),
    (nodes.complex_tables, GOLDENS["merged cells"][0], [(0, 1, True)]),
    (nodes.complex_tables, GOLDENS["odd spans"][0], [(0, 1, True)]),
    (nodes.complex_tables, GOLDENS["blocks in cells"][0], [(0, 1, True)]),
    (nodes.complex_tables, GOLDENS["spans of one"][0], [(0, 1, False)]),
    (nodes.complex_tables, "<table><tr><td colspan=' 01 ' rowspan='-5'></td></tr></table>", [(0, 1, False)]),
    (nodes.complex_tables, "<table></table>", [(0, 0, False)]),
    (nodes.pipe_tables, GOLDENS["no header row"][0], [(0, 0, "| 1 | 2 |"), (0, 1, "| 3 |")]),
    (nodes.code_blocks, GOLDENS["brush"][0], [(0, "py", " a")]),
    (nodes.code_blocks, GOLDENS["language"][0], [(0, "c-sharp", "a < b")]),
    (nodes.lifted_blocks, GOLDENS["lifted"][0], [(0, 2, "p", 3), (0, 4, "ul", 2), (0, 6, "p", 1)]),
    (nodes.spacers, "<div><br></div><p>&nbsp;<!-- --></p><div>a</div><div><div><br></div></div><p><!-- --><br></p>",
     [(0, "div"), (2, "p"), (8, "div"), (10, "p")]),
    (nodes.separators, GOLDENS["separator"][0] + GOLDENS["big separator"][0], [(1,)]),
    (nodes.widgets, GOLDENS["widgets"][0], [(1, "source-footnote", "drop"), (3, "response-element", "unwrap")]),
    (nodes.list_items, "<li>z</li><ol start=4><li>a</li>\n<li>b</li></ol>", [(0, "-", "z"), (3, "4.", "a"), (6, "5.", "b")]),
])
def test_extractors(spark, extractor, html, expected):
    assert rows(spark, extractor, html) == expected


def test_embeds(spark):
    df = nodes.with_nodes(spark.createDataFrame([(1, "<p><video><source src=a></video>")], "id INT, html STRING"))
    assert [tuple(r) for r in nodes.embeds(df, ["id"]).collect()] == [
        (1, 0, "video", '<video><source src="a"/></video>')]


def test_a_batch_is_read_in_portions():
    documents = ["<p>" + "é" * size for size in (text.PORTION_BYTES, 1, 2)] + [None, "<b>x" * 3] + ["y" * 1000] * 3000
    portions = list(nodes.parsed_html.func(iter([pa.array(documents[:4]), pa.array([], pa.string()), pa.array(documents[4:])])))
    assert [len(portion) for portion in portions] == [1, 3, 0, 1049, 1048, 904]
    found = [document for portion in portions for document in portion.to_pylist()]
    assert [[n["text"] for n in document["nodes"]] for document in found] == [read_nodes(html or "")["text"] for html in documents]
    assert [dict(found[4]["nodes"][n])["parent"] for n in (2, 4)] == [0, 2]


def test_references_are_resolved_in_portions():
    texts = ["&amp;" * 200_000, None, "a", "&lt;" + "b" * text.PORTION_BYTES]
    portions = list(text._decode.func(iter([pa.array(texts)])))
    assert [portion.to_pylist() for portion in portions] == [["&" * 200_000, None, "a"], ["<" + "b" * text.PORTION_BYTES]]


def test_portions_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 700)
    try:
        df = spark.range(3000).selectExpr("id", "concat(repeat('x', 1500), '<i>', id, '</i>') AS html").coalesce(1)
        found = nodes.with_nodes(df).select("id", F.col("nodes")[2]["text"].alias("text")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((row.id, row.text) for row in found) == [(n, str(n)) for n in range(3000)]
