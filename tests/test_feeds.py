import hashlib
import os

import pytest
from pyspark.sql import functions as F

from feeds import LEGACY, SETTINGS, TAKEOUT
from quillmill.operators.entries import parse_entries
from quillmill.sources import discovery
from quillmill.sources.discovery import (
    READ_BUFFER, READ_COLUMNS, SETTINGS_COLUMNS, discover_feeds, list_files, read_settings, with_base_url)
from quillmill.sources import feeds as reader
from quillmill.sources.feeds import read_feeds, with_entry_index
from quillmill.sources.fingerprint import compare_fingerprints, fingerprints, mutation_issues
from quillmill.staging import stage


def parsed(spark, path, base_url=None, splittable=True):
    raw = stage(read_feeds(spark, str(path), splittable=splittable), "raw")
    indexed = with_entry_index(raw, raw.count())
    return parse_entries(indexed.withColumn("base_url", F.lit(base_url).cast("string"))).orderBy("entry_index")


@pytest.mark.parametrize("splittable", [True, False])
def test_takeout_entries(spark, tmp_path, splittable):
    (tmp_path / "feed.atom").write_text(TAKEOUT, encoding="utf-8")
    rows = parsed(spark, tmp_path / "feed.atom", "https://g.example.com/", splittable).collect()
    assert [r.entry_index for r in rows] == list(range(1, 9))
    first, second, third, fourth, fifth, _, seventh, eighth = rows
    assert (first.id, first.title, first.kind, first.published) == ("p-1", 'Tomatoes | and: "basil"', "post", "2024-03-02T08:00:00Z")
    assert first.url == "https://g.example.com/2024/03/tomatoes.html"
    assert first.labels == ["soil", "seeds"] and first.updated == "2024-03-05T08:00:00Z"
    assert first.content_html == "<h3>Beds</h3><p>Two <b>raised</b> beds.</p><!-- x -->"
    assert second.published == "2024-03-02T09:00:00Z"
    assert (third.route, third.skip_kind) == ("skipped", "page") and third.is_draft
    assert (fourth.kind, fourth.title, fourth.issues) == ("comment", "Untitled Comment 4", [])
    assert (fifth.skip_kind, fifth.skip_reason) == ("trashed", "Skipped trashed/deleted entry")
    assert (seventh.id, seventh.title) == ("generated:entry-7", "Untitled Custom_widget 7")
    assert [(i.issue_type, i.post_id, i.post_title) for i in seventh.issues] == [
        ("unfamiliar_entry_type", "", ""), ("missing_id", "generated:entry-7", "")]
    assert not eighth.is_trashed and eighth.url is None and eighth.updated is None
    assert [i.issue_type for i in eighth.issues] == [
        "missing_id", "missing_title", "missing_publication_date", "missing_url"]
    assert eighth.issues[2].message == "Post 'Untitled Post 8' (generated:entry-8) is missing a published date."


@pytest.mark.parametrize("splittable", [True, False])
def test_legacy_entries(spark, tmp_path, splittable):
    (tmp_path / "old.xml").write_text(LEGACY, encoding="utf-8")
    rows = parsed(spark, tmp_path / "old.xml", None, splittable).collect()
    assert [r.kind for r in rows] == ["post", "post", "comment", "template", "post", "post"]
    assert [r.skip_kind for r in rows] == [None, "draft", "comment", "template", None, None]
    assert rows[0].url == "https://old.example.com/1.html" and rows[0].updated == ""
    assert (rows[0].author_name, rows[0].author_email) == ("Ann", "a@example.com")
    assert rows[0].labels == ["Été"]
    assert rows[4].url == "https://old.example.com/5.atom"
    assert rows[5].url is None and rows[5].author_name is None


def test_split_reader_keeps_order_over_many_splits(spark, tmp_path):
    entries = "".join(
        f"<entry>\n  <id>e-{n}</id>\n  <title>T {n}</title>\n  <content type='html'>{'x' * (n % 700)}</content>\n</entry>\n"
        for n in range(1, 3001))
    (tmp_path / "feed.atom").write_text(f"<feed>\n{entries}</feed>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = read_feeds(spark, str(tmp_path / "feed.atom"))
        assert raw.rdd.getNumPartitions() > 5
        rows = with_entry_index(stage(raw, "raw"), 3000).select("entry_index", F.col("id")[0].alias("id")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.entry_index, r.id) for r in rows) == [(n, f"e-{n}") for n in range(1, 3001)]


def entry(name, inside=""):
    return f"<entry>\n<id>{name}</id><content type='html'>{'x' * (len(name) * 37 % 90)}{inside}</content></entry>\n"


HIDDEN = [
    "<!-- <entry><id>no</id></entry> -->", "<![CDATA[<entry><id>no</id></entry>]]>", "<!-- see <entry> below -->", "<![CDATA[ </entry> ]]>",
    "<!-- <![CDATA[ --><![CDATA[<!-- </entry>]]>", "<?note </entry> <!-- ?>", "<!-- </entry></entry> <entry> " + "y" * 300 + "</entry> -->",
    "<![CDATA[" + "</entry>z" * 40 + "]]>", "", "plain", "<b>" + "w" * 200 + "</b>",
]


def shown(raw):
    rows = with_entry_index(stage(raw, "raw"), raw.count()).collect()
    return sorted((r.entry_index, r.id[0], [c._VALUE for c in r.content or []]) for r in rows)


@pytest.mark.parametrize("split_bytes", ["400", "1000", "100000"])
def test_hidden_entry_tags_over_many_splits(spark, tmp_path, split_bytes):
    inside = [HIDDEN[n % len(HIDDEN)] for n in range(60)]
    feed = "<?xml version='1.0'?>\n<feed><!-- <entry> --><x>" + HIDDEN[1] + "</x>"
    feed += "".join(entry(f"e-{n}", one) + (HIDDEN[6] if n % 9 == 0 else "") for n, one in enumerate(inside)) + "<!-- </entry> --></feed>\n"
    (tmp_path / "one.atom").write_text(feed)
    (tmp_path / "two.atom").write_text("<feed>" + "".join(entry(f"plain {n}") for n in range(30)) + "</feed>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        raw = read_feeds(spark, str(tmp_path))
        got = {name: [row for row in shown(raw.where(F.col("feed_path").endswith(name)))] for name in ("one.atom", "two.atom")}
        splits = raw.select("feed_path", "block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert splits > (20 if split_bytes == "400" else 1)
    for name in got:
        assert got[name] == shown(read_feeds(spark, str(tmp_path / name), splittable=False))
    assert [row[:2] for row in got["one.atom"]] == [(n + 1, f"e-{n}") for n in range(60)]
    assert got["one.atom"][1][2] == ["x" * (3 * 37 % 90) + "<entry><id>no</id></entry>"]
    assert [row[:2] for row in got["two.atom"]] == [(n + 1, f"plain {n}") for n in range(30)]


@pytest.mark.parametrize("hidden", HIDDEN)
@pytest.mark.parametrize("splittable", [True, False])
def test_sections_before_the_first_entry(spark, tmp_path, hidden, splittable):
    (tmp_path / "feed.atom").write_text(f"<feed><x>{hidden}</x><entry><id>yes</id></entry></feed>")
    rows = read_feeds(spark, str(tmp_path / "feed.atom"), splittable=splittable).collect()
    assert [r.id for r in rows] == [["yes"]]


def test_entries_within_entries(spark, tmp_path):
    inner = "<source><entry><id>inner</id></entry><entry><id>inner 2</id></entry></source>"
    feed = f"<feed>{entry('a')}<entry>{inner}<id>b</id></entry>{entry('c')}<entry><id>d</id>{inner}</entry></feed>"
    (tmp_path / "feed.atom").write_text(feed)
    assert [row[:2] for row in shown(read_feeds(spark, str(tmp_path)))] == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


@pytest.mark.parametrize("splittable", [True, False])
@pytest.mark.parametrize("inside, published, kind", [
    ("<created>c</created><published></published>", "", "post"), ("<published/><created>c</created>", "c", "post"),
    ("<created>c</created><published>p</published>", "p", "post"), ("<published>p</published><created>c</created>", "p", "post"),
    ("<created/><created>c</created><published/><created>d</created>", "d", "post"),
    ("<in-reply-to ref='x'/><category scheme='#kind' term='k#post'/>", "", "post"),
    ("<category scheme='#kind' term='k#post'/><thr:in-reply-to ref='x'/>", "", "comment"),
    ("<category scheme='#kind' term='k#page'/><inReplyTo>x</inReplyTo>", "", "page"),
    ("<inReplyTo>x</inReplyTo><category scheme='#kind' term=''/><category term='k#post'/>", "", "comment"),
    ("<type>PAGE</type><in-reply-to ref='x'/><category scheme='#kind' term='k#post'/>", "", "page"),
    ("<content><x><published>no</published></x></content><created a='>'>c</created><x><category scheme='#kind' term='#page'/></x>", "c", "post"),
    ("<content><![CDATA[<published>]]></content><created>c</created><!-- <published/> -->", "c", "post")])
def test_tag_order(spark, tmp_path, splittable, inside, published, kind):
    (tmp_path / "feed.atom").write_text(f"<feed><entry>{inside}</entry></feed>")
    row = parsed(spark, tmp_path, splittable=splittable).first()
    assert (row.published, row.kind) == (published, kind)


@pytest.mark.parametrize("splittable", [True, False])
@pytest.mark.parametrize("content, expected", [
    ("a<![CDATA[<b> <!-- kept --> &amp;]]>c &#160;&#x1F600; &quot;", "a<b> <!-- kept --> &amp;c \xa0😀 \""),
    ("\n lead &lt;p&gt; tail \n ", "\n lead <p> tail \n "), ("", ""), ("a\r\nb", "a\nb"),
    ("x<!-- gone --> y<!-- and --> <![CDATA[<!-- z -->]]>", "x y <!-- z -->")])
def test_content_text(spark, tmp_path, splittable, content, expected):
    (tmp_path / "feed.atom").write_text(
        f"<feed><entry><content type='html'>{content}</content></entry></feed>", encoding="utf-8", newline="")
    assert parsed(spark, tmp_path, splittable=splittable).first().content_html == expected


@pytest.mark.parametrize("splittable", [True, False])
@pytest.mark.parametrize("feed, ids", [
    ("<a:feed xmlns:a='x'><a:entry><a:id>1</a:id></a:entry><a:entry><a:id>2</a:id></a:entry></a:feed>", [["1"], ["2"]]),
    ("<feed><entry ><id>1</id></entry ><entry a='/>'><id>2</id></entry\n></feed>", [["1"], ["2"]]),
    ("<feed><entry/><entry><id>2</id></entry><entry /></feed>", [None, ["2"], None]), ("<feed/>", []), ("", [])])
def test_other_spellings(spark, tmp_path, splittable, feed, ids):
    (tmp_path / "feed.atom").write_text(feed)
    assert [r.id for r in read_feeds(spark, str(tmp_path), splittable=splittable).orderBy("piece", "sub").collect()] == ids


@pytest.mark.parametrize("splittable", [True, False])
def test_other_encoding(spark, tmp_path, splittable):
    feed = "<?xml version='1.0' encoding=\"ISO-8859-1\"?><feed><entry><title>é</title></entry></feed>"
    (tmp_path / "feed.atom").write_bytes(feed.encode("latin-1"))
    rows = read_feeds(spark, str(tmp_path), splittable=splittable, encoding="iso-8859-1").collect()
    assert rows[0].title[0]._VALUE == "é"
    with pytest.raises(Exception, match="another encoding"):
        read_feeds(spark, str(tmp_path), splittable=splittable).collect()


def test_wide_characters_are_read_whole(spark, tmp_path):
    (tmp_path / "feed.atom").write_bytes("<feed><entry><title>é</title></entry></feed>".encode("utf-16"))
    with pytest.raises(ValueError, match="splittable=False"):
        read_feeds(spark, str(tmp_path), encoding="UTF-16")
    assert read_feeds(spark, str(tmp_path), splittable=False, encoding="UTF-16").first().title[0]._VALUE == "é"


def test_repeated_tags(spark, tmp_path):
    (tmp_path / "feed.atom").write_text(
        "<feed><entry><id>a</id><id>b</id><status>DRAFT</status><status>LIVE</status><created>c1</created>"
        "<created>c2</created><author><name>x</name></author><author><email>e</email></author></entry></feed>")
    row = parsed(spark, tmp_path / "feed.atom").first()
    assert (row.id, row.is_draft, row.published, row.author_name) == ("b", True, "c1", "x")


def test_discovery(spark, tmp_path):
    files = [
        "one/Blogs/a b/feed.atom", "one/Comments/feed.atom", "one/x.xml",
        "two/theme-1.xml", "two/z.xml", "two/Comments/a.xml",
        "three/Comments/c.atom", "three/plain.xml", "four/sub/feed.atom", "four/feed.atom", "five/readme.txt",
        "Notes [2020] {a,b}*?/x%20+y.atom",
    ]
    for name in files:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("<feed/>")
    found = {
        r.archive.rsplit("/", 1)[1]: r.feed_path.split(str(tmp_path))[1]
        for r in discover_feeds(spark, str(tmp_path), depth=1).collect()}
    assert found == {
        "one": "/one/Blogs/a b/feed.atom", "two": "/two/z.xml",
        # The first pattern with any match decides, even if all its matches are comment feeds.
        "three": "/three/Comments/c.atom", "four": "/four/feed.atom",
        "Notes [2020] {a,b}*?": "/Notes [2020] {a,b}*?/x%20+y.atom"}
    odd = tmp_path / "Notes [2020] {a,b}*?"
    assert [r.feed_path for r in discover_feeds(spark, str(odd)).collect()] == [f"{odd}/x%20+y.atom"]
    (odd / "x%20+y.atom").write_text("<feed><entry><id>1</id></entry></feed>")
    assert [r.feed_path for r in read_feeds(spark, str(odd)).collect()] == [f"{odd}/x%20+y.atom"]
    assert discover_feeds(spark, str(tmp_path / "two")).first().feed_path.endswith("/two/z.xml")


def test_settings(spark, tmp_path):
    blogs = tmp_path / "Blogs"
    for name in ("near", "quiet", "bare"):
        (blogs / name).mkdir(parents=True)
    (blogs / "near" / "settings.csv").write_text(SETTINGS, encoding="utf-8")
    (blogs / "quiet" / "settings.csv").write_text("blog_name\nx\n")
    (blogs / "settings.csv").write_text("blog_subdomain\nupper\n")
    settings = read_settings(spark, str(tmp_path))
    root = settings.where("folder LIKE '%/Blogs'").first().folder
    feeds = spark.createDataFrame([(f"{root}/{name}/feed.atom",) for name in ("near", "quiet", "bare")], "feed_path STRING")
    for total in (3, 10**9):
        found = {r.feed_path.split("/")[-2]: r.base_url for r in with_base_url(feeds, settings, total).collect()}
        assert found == {"near": "https://gardennotes.blogspot.com", "quiet": None, "bare": "https://upper.blogspot.com"}


@pytest.mark.parametrize("content, expected", [
    (b"\xff\xfe", None), (b"", None), (b"blog_name,blog_subdomain\nonly\n", None), (b"blog_subdomain\n", None), (b"blog_subdomain\n \n", None),
    (b'a,blog_subdomain,b\n"x, ""y""\nz", near ,c\n,other,\n', "near"), (b"blog_subdomain,a\r\nnear,1\r\n", "near"),
    (b"\n\nblog_subdomain\n\nnear\n", "near"), (b"a\nb\n", None)])
def test_settings_of_one_file(spark, tmp_path, content, expected):
    (tmp_path / "settings.csv").write_bytes(content)
    found = [r.base_url for r in read_settings(spark, str(tmp_path)).collect()]
    assert found == ([f"https://{expected}.blogspot.com"] if expected else [None]) or (not content.strip() and found == [])


def wide_settings(columns, at, eol="\r\n", value='"near"'):
    names = [f'"n,{n}"' if n % 10 == 3 else f"n{n}" for n in range(columns)]
    values = [f'"a ""b"", {n}{eol}c"' if n % 7 == 2 else "" if n % 5 == 1 else f"v{n}" for n in range(columns)]
    names[at], values[at] = "blog_subdomain", value
    return f"{eol}{','.join(names)}{eol}{eol}{','.join(values)}{eol}other{eol}".encode()


@pytest.mark.parametrize("eol", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("columns, at", [(n, at) for n in (READ_COLUMNS - 1, READ_COLUMNS, READ_COLUMNS + 1, 200) for at in (0, n - 1)])
def test_settings_of_many_columns(spark, tmp_path, columns, at, eol):
    (tmp_path / "settings.csv").write_bytes(wide_settings(columns, at, eol))
    assert [r.base_url for r in read_settings(spark, str(tmp_path)).collect()] == ["https://near.blogspot.com"]


def test_settings_with_cells_larger_than_what_is_read_at_once(spark, tmp_path):
    long = '"' + "w, \"\"" * int(READ_BUFFER) + '"'
    for name, columns in (("few", 3), ("many", READ_COLUMNS + 10)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "settings.csv").write_text(wide_settings(columns, columns - 1, "\n").decode().replace("v0", long))
    assert [r.base_url for r in read_settings(spark, str(tmp_path)).collect()] == ["https://near.blogspot.com"] * 2


def test_settings_files_are_opened_once(spark, tmp_path):
    for n in range(3):
        (tmp_path / "Blogs" / f"b{n}").mkdir(parents=True)
        (tmp_path / "Blogs" / f"b{n}" / "settings.csv").write_text(f"blog_subdomain\nb{n}\n")
    feeds = spark.createDataFrame([(f"{tmp_path}/Blogs/b{n}/feed.atom",) for n in range(3)], "feed_path STRING")
    before = spark.conf.get(reader.OPEN_COST)
    # Counting hot keys and either side of the join would else read all files again.
    found = with_base_url(feeds, read_settings(spark, str(tmp_path)), 10**9)
    assert not [path for path in found.inputFiles() if path.endswith("settings.csv")]
    assert spark.conf.get(reader.OPEN_COST) == before
    assert sorted(r.base_url for r in found.collect()) == [f"https://b{n}.blogspot.com" for n in range(3)]


def test_settings_are_read_with_few_columns(spark, tmp_path):
    # The CSV reader is set up anew for each file, in a time that grows with the square of the columns.
    (tmp_path / "settings.csv").write_text("blog_subdomain\nx\n")
    scanned = read_settings(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().collectLeaves().head().output().size()
    assert scanned <= READ_COLUMNS + 3 < SETTINGS_COLUMNS


def test_fingerprints(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / name).write_text(name)
    before = stage(fingerprints(spark, str(tmp_path)), "before")
    (tmp_path / "b").write_text("B")
    (tmp_path / "c").unlink()
    after = fingerprints(spark, str(tmp_path))
    compared = compare_fingerprints(before, after)
    assert {r.feed_path[-1]: r.unmodified for r in compared.collect()} == {"a": True, "b": False, "c": False}
    assert {r.severity for r in mutation_issues(compared).collect()} == {"error"}
    assert all(len(r.sha256) == 64 for r in before.collect())


@pytest.mark.parametrize("splittable", [True, False])
@pytest.mark.parametrize("content, expected", [
    ("lead <div>inner</div>", "lead "), ("lead <div a='>'>in<![CDATA[</content>]]>ner</div> tail <br/>end", "lead "), ("<div>inner</div> tail", ""),
    ("a<!-- x --> b&amp;<![CDATA[<p>]]>c<br/>d", "a b&<p>c"), ("<![CDATA[a <content>b <p>c</p></content>]]>", "a <content>b <p>c</p></content>"),
    ("x" * 200000 + "<p>y</p>" * 20000, "x" * 200000)])
def test_text_before_child_elements(spark, tmp_path, splittable, content, expected):
    (tmp_path / "feed.atom").write_text(
        f"<feed><entry><title>t</title><content type='a>b'>{content}</content><id>i</id></entry><entry><content src='u'/><id>j</id></entry></feed>")
    first, second = parsed(spark, tmp_path, splittable=splittable).collect()
    assert (first.content_html, first.title, first.id) == (expected, "t", "i")
    assert (second.content_html, second.id) == ("", "j")


def test_large_files_are_hashed_too(spark, tmp_path):
    large = tmp_path / "large one%20.xml"
    with large.open("wb") as file:  # mostly a hole, so it takes no disk
        file.truncate(512 * 2**20 + 1)
    (tmp_path / "small.xml").write_bytes(b"a")
    before = stage(fingerprints(spark, str(tmp_path)), "before")
    with large.open("rb") as file:
        want = {hashlib.file_digest(file, "sha256").hexdigest(), hashlib.sha256(b"a").hexdigest()}
    assert {r.sha256 for r in before.collect()} == want
    times = large.stat()
    with large.open("r+b") as file:
        file.write(b"!")
    os.utime(large, ns=(times.st_atime_ns, times.st_mtime_ns))
    compared = compare_fingerprints(before, stage(fingerprints(spark, str(tmp_path)), "after"))
    assert sorted((r.feed_path[-9:], r.unmodified) for r in compared.collect()) == [("one%20.xml"[-9:], False), ("small.xml", True)]


ODD_FEEDS = {
    "mark.atom": b"\xef\xbb\xbf<?xml version='1.0'?><feed><entry><id>a</id></entry>\n<entry><id>b</id></entry></feed>",
    "empty.atom": b"", "cut.atom": b"<feed><entry><id>a</id></entry>", "bytes.atom": b"<entry><id>\xff\xc3</id></entry><x></</entry>",
    "hidden.atom": b"<!-- </entry> --><entry><id>a</id><!-- </entry><entry> --></entry><entry><id>b</id></entry>",
    "inner.atom": b"<entry><id>a</id><x><entry a='1'/></x></entry> <entry><id>b <entry><id>c</id></entry></id></entry>",
    "x%20+[y]{z}.atom": "<feed><entry><id>\u00e9</id></entry></feed>".encode(),
}


@pytest.mark.parametrize("small", [0, 60, 1 << 20])
def test_listed_feeds_are_opened_by_their_names(spark, tmp_path, monkeypatch, small):
    for name, data in ODD_FEEDS.items():
        (tmp_path / name).write_bytes(data)
    monkeypatch.setattr(reader, "SMALL_BYTES", small)
    listed = stage(list_files(spark, str(tmp_path)).withColumnRenamed("path", "feed_path").where("feed_path NOT LIKE '%/mark.atom'"), "listed")

    def entries(feeds):
        rows = read_feeds(spark, str(tmp_path), feeds).orderBy("feed_path", "block", "piece", "sub").collect()
        return [(row.feed_path, row.id, row.tags) for row in rows]

    assert entries(listed) == entries(listed.select("feed_path"))
    assert {path.rpartition("/")[2] for path, *_ in entries(listed)} == set(ODD_FEEDS) - {"mark.atom", "empty.atom"}


def test_pieces_are_those_of_the_text_source(spark, tmp_path):
    for name, data in ODD_FEEDS.items():
        path = tmp_path / name.replace("[y]{z}", "")
        path.write_bytes(data)
        rows = spark.read.text(str(path), lineSep=reader.CUT).selectExpr("CAST(value AS BINARY) AS value").collect()
        assert [bytes(row.value) for row in rows] == reader.cut_bytes(data)


def test_files_that_are_not_listed_are_not_read(spark, tmp_path):
    (tmp_path / "a.atom").write_text("<entry><id>a</id></entry>")
    (tmp_path / "b.gz").write_bytes(b"not packed")
    feeds = stage(list_files(spark, str(tmp_path)).withColumnRenamed("path", "feed_path").where("feed_path LIKE '%.atom'"), "listed")
    assert [row.id for row in read_feeds(spark, str(tmp_path), feeds).collect()] == [["a"]]


@pytest.mark.parametrize("folders", [1, 3, 1000])
def test_files_are_listed_in_tasks_as_by_spark(spark, tmp_path, monkeypatch, folders):
    root = tmp_path / "a b%20[c]{d,e}*"
    for name in ("feed.atom", "x/feed.atom", "x/y/z/é.atom", "x/y/z/w/q.xml", ".h/feed.atom", "_h/feed.atom", "_k=1/feed.atom", "x/_feed.atom",
                 "x/.a.atom", "x/a.atom._COPYING_", "_metadata.xml", "b:c/feed.atom", "s/settings.csv", "s/t.txt", "s/xml", "s/feed.atom.xml/feed.atom"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("x" * len(name))
    (root / "empty").mkdir()
    (root / "s" / "e.xml").write_text("")
    (root / "s" / "gone.xml").symlink_to(root / "nowhere")
    (root / "linked").symlink_to(root / "x")
    monkeypatch.setattr(discovery, "FOLDERS", folders)
    for pattern in ("*", discovery.FEED_NAMES, "settings.csv"):
        found = list_files(spark, str(root), pattern)
        # The driver knows staged tables only.
        assert not [path for path in found.inputFiles() if not path.endswith(".parquet")]
        with monkeypatch.context() as patch:
            patch.setattr(discovery, "_local_folder", lambda spark, root: None)
            by_spark = list_files(spark, str(root), pattern)
        assert set(found.collect()) ^ set(by_spark.collect()) == set()
        assert found.count() == by_spark.count() > 0


def test_settings_are_read_in_portions(spark, tmp_path, monkeypatch):
    names = [f"b{n} [x]{{y}}*%20" for n in range(11)]
    for n, name in enumerate(names):
        (tmp_path / name).mkdir()
        (tmp_path / name / "settings.csv").write_text(f"blog_name,blog_subdomain\n\"a,\nb\",b{n}\n")
    cached, cost = spark.conf.get(reader.FILE_CACHE), spark.conf.get(reader.OPEN_COST)
    read, real = [], discovery._settings
    monkeypatch.setattr(discovery, "_settings", lambda spark, paths, **options: (
        read.append((len(paths), spark.conf.get(reader.FILE_CACHE))), real(spark, paths, **options))[1])
    monkeypatch.setattr(discovery, "PORTION", 4)
    found = read_settings(spark, str(tmp_path))
    assert not [path for path in found.inputFiles() if not path.endswith(".parquet")]
    assert sorted(map(tuple, found.collect())) == sorted((f"{tmp_path}/{name}", f"https://b{n}.blogspot.com") for n, name in enumerate(names))
    assert len(read) == 3 and sum(number for number, _ in read) == 11 and {cache for _, cache in read} == {"0"}
    assert (spark.conf.get(reader.FILE_CACHE), spark.conf.get(reader.OPEN_COST)) == (cached, cost)
    empty = tmp_path / names[0] / "empty"
    empty.mkdir()
    assert read_settings(spark, str(empty)).collect() == []


@pytest.mark.parametrize("name", ["feed.atom", "settings.csv"])
def test_many_folders_are_listed_in_few_tasks(spark, tmp_path, name):
    for n in range(200):
        (tmp_path / f"b{n}").mkdir()
        (tmp_path / f"b{n}" / name).write_text("<feed/>")
    before = spark.conf.get(reader.LISTING_TASKS)
    spark.sparkContext.setJobGroup("listing", "")
    try:
        found = discover_feeds(spark, str(tmp_path), 1) if name == "feed.atom" else read_settings(spark, str(tmp_path))
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert 0 < max(info.numTasks for info in stages if info) <= reader.TASKS_PER_CORE * spark.sparkContext.defaultParallelism < 200
    assert spark.conf.get(reader.LISTING_TASKS) == before
    assert found.count() == 200
    assert name != "feed.atom" or found.select("size").distinct().collect() == [(7,)]
