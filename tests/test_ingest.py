"""The whole job on two small feeds."""

import json
from pathlib import Path

import pytest

from feeds import LEGACY, SETTINGS, TAKEOUT
from quillmill.plans import report
from quillmill.plans.ingest import ingest


def text_of(folder: Path) -> str:
    return "".join(part.read_text(encoding="utf-8") for part in sorted(folder.glob("part-*")))


@pytest.fixture(scope="module")
def takeout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("takeout")
    blog = root / "in" / "Blogs" / "Garden"
    blog.mkdir(parents=True)
    (blog / "feed.atom").write_text(TAKEOUT, encoding="utf-8")
    (blog / "settings.csv").write_text(SETTINGS, encoding="utf-8")
    out = root / "out"
    done = ingest(spark, str(root / "in"), str(out), one_file_per_post=True, extra_metadata={"source": "garden"})
    return done, out


def test_counts(takeout):
    row = takeout[0].summary.first()
    assert (row.total_entries, row.published_posts_found, row.converted_count, row.skipped_count, row.duplicate_count) == (8, 4, 3, 4, 1)
    assert row.skipped_breakdown == {"page": 1, "comment": 1, "trashed": 1, "custom_widget": 1}
    assert row.input_file_unmodified and len(row.input_file_hash_sha256) == 64
    assert row.total_entries == row.skipped_count + row.published_posts_found
    assert row.published_posts_found == row.converted_count + row.duplicate_count


def test_files(takeout):
    done, out = takeout
    names = [r.file_name for r in done.converted.orderBy("entry_index").collect()]
    assert names == ["2024-03-02-tomatoes-and-basil.md", "2024-03-02-tomatoes-and-basil-2.md", "undated-untitled-post-8.md"]
    assert sorted(names) == sorted(f.name for f in out.glob("*.md"))
    assert (out / names[0]).read_text(encoding="utf-8") == """---
title: "Tomatoes | and: \\"basil\\""
date: "2024-03-02T08:00:00Z"
url: "https://gardennotes.blogspot.com/2024/03/tomatoes.html"
labels:
- "soil"
- "seeds"
classification: "personal_analysis"
type: "personal_analysis"
id: "p-1"
updated: "2024-03-05T08:00:00Z"
"source": "garden"
---

### Beds

Two **raised** beds.
"""
    assert (out / names[2]).read_text(encoding="utf-8").endswith('"source": "garden"\n---\n\n')


def test_duplicates_and_issues(takeout):
    done, _ = takeout
    duplicate = done.duplicates.first()
    assert (duplicate.post_id, duplicate.first_seen_file) == ("p-6", "2024-03-02-tomatoes-and-basil.md")
    found = done.issues.orderBy("entry_index", "seq").collect()
    assert [i.issue_type for i in found] == [
        "duplicate_post", "unfamiliar_entry_type", "missing_id", "missing_id", "missing_title",
        "missing_publication_date", "missing_url"]


def test_json_report(takeout):
    done, out = takeout
    data = json.loads(text_of(out / "reports" / "json"))
    assert list(data) == ["summary", "converted_posts", "skipped_entries", "duplicates", "issues"]
    assert data["summary"]["skipped_breakdown"] == {"comment": 1, "custom_widget": 1, "page": 1, "trashed": 1}
    assert data["summary"]["issue_count"] == len(data["issues"]) == 7
    assert data["converted_posts"][0]["labels"] == ["soil", "seeds"] and data["converted_posts"][2]["url"] is None
    assert [s["kind"] for s in data["skipped_entries"]] == ["page", "comment", "trashed", "custom_widget"]
    assert list(data["duplicates"][0]) == ["post_id", "title", "url", "reason", "first_seen_file"]


def test_markdown_report(takeout):
    lines = text_of(takeout[1] / "reports" / "markdown").split("\n")
    assert lines[0] == "# Blogger / Blogspot Ingestion Report"
    assert "| **Successfully Converted** | 3 |" in lines
    at = lines.index("### Skipped Entries Breakdown")
    assert lines[at + 4:at + 9] == ["| Comment | 1 |", "| Custom_widget | 1 |", "| Page | 1 |", "| Trashed | 1 |", ""]
    assert '| 2024-03-02 | Tomatoes \\| and: "basil" | `2024-03-02-tomatoes-and-basil.md` | soil, seeds |' in lines
    assert lines[-3:] == ["|  | Untitled Post 8 | `undated-untitled-post-8.md` | - |", "", ""]
    assert "| WARNING | `unfamiliar_entry_type` | N/A | Encountered unfamiliar entry type 'custom_widget' at index 7. |" in lines


def test_many_archives_dry_run(spark, tmp_path):
    for name, feed in (("a", TAKEOUT), ("b", LEGACY), ("c", TAKEOUT)):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "feed.atom").write_text(feed, encoding="utf-8")
    out = tmp_path / "out"
    done = ingest(spark, str(tmp_path / "in"), str(out), depth=1, dry_run=True, base_url="https://x.example.com", splittable=False)
    assert not out.exists()
    found = {r.input_file.split("/")[-2]: (r.total_entries, r.converted_count, r.skipped_count, r.duplicate_count) for r in done.summary.collect()}
    # Ids repeat over the archives; each archive is deduplicated by itself.
    assert found == {"a": (8, 3, 4, 1), "b": (6, 2, 3, 1), "c": (8, 3, 4, 1)}
    assert done.converted.select("file_path").distinct().count() == 8
    assert report.totals(done.entries).where("feed_path IS NULL").first().total_entries == 22
    markdown = {r.title: r.markdown for r in done.documents.collect()}
    assert markdown["Straße & Café"] == '<table><tr><th colspan="2">A</th></tr></table>'
    assert done.documents.where("title LIKE 'Stra%'").first().file_name == "2020-01-01-strae-cafe.md"


def test_write_failures_are_issues(spark, tmp_path):
    (tmp_path / "feed.atom").write_text(LEGACY, encoding="utf-8")
    out = tmp_path / "out"
    (out / "2020-01-05-feed-link-only.md").mkdir(parents=True)
    done = ingest(spark, str(tmp_path / "feed.atom"), str(out), one_file_per_post=True)
    row = done.summary.first()
    assert (row.published_posts_found, row.converted_count, row.duplicate_count) == (3, 1, 1)
    issue = done.issues.where("issue_type = 'file_write_error'").first()
    assert issue.severity == "error" and issue.message.startswith(f"Failed to write markdown file '{out}/2020-01-05-feed-link-only.md': ")


def test_relative_paths(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "old.xml").write_text(LEGACY, encoding="utf-8")
    monkeypatch.chdir(tmp_path)
    for source, out in (("in/old.xml", "out1"), ("in", "out2/")):
        done = ingest(spark, source, out, one_file_per_post=True)
        assert done.summary.first().converted_count == 2
        assert len(list((tmp_path / out).glob("*.md"))) == 2


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest(spark, str(tmp_path / "nothing.xml"))
    (tmp_path / "readme.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        ingest(spark, str(tmp_path))


def test_breakdown_has_all_kinds_of_every_feed(spark):
    skipped = spark.range(2_000).selectExpr("IF(id < 1999, 'many', 'few') AS feed_path", "concat('k', id) AS kind")
    found = {r.feed_path: r.skipped_breakdown for r in report.breakdown_map(report.skipped_breakdown(skipped)).collect()}
    assert found == {"many": {f"k{i}": 1 for i in range(1999)}, "few": {"k1999": 1}}


def test_breakdown_of_nothing_is_empty(spark):
    feeds = spark.createDataFrame([("a", "x", True)], "feed_path string, sha256 string, unmodified boolean")
    rows = spark.createDataFrame([], "feed_path string, route string, kind string")
    made = report.summary(feeds, rows, rows, rows, rows, report.skipped_breakdown(rows), output_dir="out")
    assert made.select("skipped_breakdown").collect() == [({},)]


def test_files_are_whole_or_absent(spark, tmp_path):
    from quillmill.sources.sinks import SCRATCH, clear_scratch, export_files, write_issues

    root = tmp_path / "out"
    (root / SCRATCH).mkdir(parents=True)
    (root / SCRATCH / "half a file of a lost task").write_text("ha")
    (root / "blocked").write_text("a file")
    (root / "old.md").write_text("longer text that was there before")
    rows = [("f", 1, "a", "A", f"{root}/posts [1]/a.md", "é\n"), ("f", 2, "b", "B", f"{root}/blocked/b.md", "x"), ("f", 3, "c", "C", f"{root}/old.md", "new")]
    documents = spark.createDataFrame(rows, "feed_path STRING, entry_index BIGINT, id STRING, title STRING, file_path STRING, document STRING")
    for _ in range(2):
        failed = write_issues(export_files(documents, str(root))).collect()
    clear_scratch(str(root))
    clear_scratch(str(root))
    assert [(i.post_id, i.issue_type, i.severity) for i in failed] == [("b", "file_write_error", "error")]
    found = {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file() and p.suffix != ".crc"}
    assert found == {"posts [1]/a.md": "é\n", "blocked": "a file", "old.md": "new"}
    assert not (root / SCRATCH).exists()
