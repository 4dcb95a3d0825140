"""The whole job: feeds -> documents, details and reports.

The feed files are parsed once into a staged table. Decisions (dedup, names) run on narrow
columns of it; the HTML is joined back only for the posts that stay, and converted last.
"""

from __future__ import annotations

import os.path
import re
import time
from dataclasses import dataclass
from typing import Any, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillmill.operators import entries as ops
from quillmill.operators.dedup import duplicate_posts, kept_posts
from quillmill.operators.documents import CLASSIFICATION, converted_records, with_document
from quillmill.operators.markdown import Rule, conversion_issues, html_to_markdown
from quillmill.operators.names import file_names, with_base_name
from quillmill.operators.skew import keyed_join
from quillmill.plans import report
from quillmill.session import ship
from quillmill.sources.discovery import (
    FEED_NAMES, bare_path, discover_feeds, list_files, read_settings, read_settings_at, with_base_url)
from quillmill.sources.feeds import read_feeds, small_files, with_entry_index
from quillmill.sources.fingerprint import compare_fingerprints, fingerprints, mutation_issues
from quillmill.sources.sinks import clear_scratch, export_files, write_documents, write_issues, write_lines
from quillmill.staging import size_shuffles, stage, stage_counted

ROW = ["feed_path", "entry_index"]


@dataclass
class Ingested:
    """Everything a run yields, as DataFrames."""

    entries: DataFrame
    skipped: DataFrame
    duplicates: DataFrame
    documents: DataFrame
    converted: DataFrame
    issues: DataFrame
    breakdown: DataFrame
    summary: DataFrame

    def markdown_report(self, generated_on: str | None = None) -> DataFrame:
        return report.markdown_lines(
            self.summary, self.breakdown, self.duplicates, self.issues, self.converted, generated_on=generated_on)

    def json_report(self) -> DataFrame:
        total = self.entries.count() + self.issues.count()
        return report.json_lines(
            self.summary, self.breakdown, self.duplicates, self.issues, self.converted, self.skipped, total)


def absolute(path: str) -> str:
    """A path Spark and Python understand alike: a URI as it is, a relative path resolved here."""
    return path if re.match("[a-z][a-z0-9+.-]*:", path) else os.path.abspath(path)


def find_feeds(spark: SparkSession, source: str, depth: int = 0) -> DataFrame:
    """`feed_path`: feed files of a file, an archive folder or (`depth` > 0) a folder of archives."""
    try:
        files = list_files(spark, source)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input path does not exist: {source}") from error
        raise
    single = files.where(F.col("path") == bare_path(source)).select(F.col("path").alias("feed_path"))
    return single.unionByName(discover_feeds(spark, source, depth).select("feed_path")).distinct()


def find_settings(spark: SparkSession, source: str, single: bool) -> DataFrame:
    """Settings that may go with the feeds: beside or above a single file, or within a folder."""
    above = source.rstrip("/").rpartition("/")[0]
    if single:
        return read_settings_at(spark, [above, above.rpartition("/")[0]])
    return read_settings(spark, source).unionByName(read_settings_at(spark, [above]))


def ingest(
    spark: SparkSession, source: str, output_dir: str = "output/posts", *, depth: int = 0,
    base_url: str | None = None, classification: str = CLASSIFICATION,
    extra_metadata: Mapping[str, Any] | None = None, overrides: dict[str, str | Rule] | None = None,
    splittable: bool = True, encoding: str = "UTF-8", dry_run: bool = False, one_file_per_post: bool = False,
) -> Ingested:
    """Run the job on `source` and, unless `dry_run`, write below `output_dir`:
    `documents` (parquet), `reports/json`, `reports/markdown` and, on demand, one file per post.
    """
    started = time.monotonic()
    ship(spark)
    source, output_dir = absolute(source), absolute(output_dir)
    with small_files(spark):
        found, number = stage_counted(find_feeds(spark, source, depth), "found")
    if not number:
        raise FileNotFoundError(f"No feed.atom, atom.feed, or XML archive found inside directory: {source}")
    single = number == 1 and found.first().feed_path == bare_path(source)
    # A file that is named goes by any name; among others only those that may be feeds are opened.
    names = "*" if single else FEED_NAMES
    before = stage(fingerprints(spark, source, found, names), "before")
    size_shuffles(spark, before.agg(F.sum("size")).first()[0])

    raw = read_feeds(spark, source, before, splittable=splittable, encoding=encoding, names=names)
    scanned, total = stage_counted(
        raw.withColumns({
            "content_html": ops.content_html(),
            # Lets the HTML of entries that are skipped anyway stay behind before it is shuffled.
            "is_post": (ops.kind(F.col("tags")) == "post") & ~ops.is_draft() & ~ops.is_trashed(),
        }).drop("content"), "scanned")
    feeds = before.select("feed_path")
    if base_url:
        feeds = feeds.withColumn("base_url", F.lit(base_url))
    else:
        feeds = stage(with_base_url(feeds, find_settings(spark, source, single), number), "feeds")
    indexed = with_entry_index(scanned.drop("content_html", "is_post"), total)
    entries = stage(
        ops.parse_entries(keyed_join(indexed, feeds, ["feed_path"], "left", total)), "entries")

    decided = decide(entries, total)
    duplicates = stage(decided.duplicates, "duplicates")
    documents = convert_posts(
        entries, decided.kept, scanned.where("is_post").select("row_id", "content_html"), classification=classification,
        extra_metadata=extra_metadata, overrides=overrides)
    # One name space per feed: among several, each feed gets a folder of its own.
    folder = F.lit(output_dir) if number == 1 else F.concat(F.lit(f"{output_dir}/"), F.md5("feed_path"))
    documents = documents.withColumn("file_path", F.concat(folder, F.lit("/"), F.col("file_name")))
    if dry_run:
        documents = stage(documents, "documents")
    else:
        write_documents(documents, f"{output_dir}/documents")
        documents = spark.read.schema(documents.schema).parquet(f"{output_dir}/documents")

    failed = None
    if one_file_per_post and not dry_run:
        failed = stage(write_issues(export_files(documents, output_dir)), "write_issues")
        clear_scratch(output_dir)
    written = documents.join(failed.select(ROW), ROW, "left_anti") if failed is not None else documents
    compared = compare_fingerprints(before, stage(fingerprints(spark, source, found, names), "after"))

    skipped = ops.skipped(entries)
    breakdown = report.skipped_breakdown(skipped)
    converted = converted_records(written, folder, classification)
    issues = report.all_issues(
        ops.entry_issues(entries), report.duplicate_issues(duplicates), conversion_issues(documents),
        mutation_issues(compared), *([failed] if failed is not None else []))
    result = Ingested(
        entries=entries, skipped=skipped, duplicates=duplicates, documents=written, converted=converted,
        issues=issues, breakdown=breakdown,
        summary=report.summary(
            compared, entries, converted, duplicates, issues, breakdown, output_dir=folder,
            duration_seconds=time.monotonic() - started),
    )
    if not dry_run:
        write_lines(result.json_report(), report.LINE_ORDER, f"{output_dir}/reports/json")
        write_lines(result.markdown_report(), report.LINE_ORDER, f"{output_dir}/reports/markdown")
    return result


@dataclass
class Decided:
    kept: DataFrame
    duplicates: DataFrame


def decide(entries: DataFrame, total: int) -> Decided:
    """Which published posts stay and under which name; `entries`, `total` of them, are staged."""
    posts = ops.published(entries).select(*ROW, "id", "title", "published", "url")
    named = with_base_name(kept_posts(posts).join(posts.select(*ROW, "title", "published"), ROW))
    kept = stage(file_names(named.select(*ROW, "id", "url", "base")), "named")
    return Decided(kept=kept, duplicates=duplicate_posts(posts, kept, total))


def convert_posts(
    entries: DataFrame, kept: DataFrame, contents: DataFrame, *, classification: str | Column = CLASSIFICATION,
    extra_metadata: Mapping[str, Any] | Column | None = None, overrides: dict[str, str | Rule] | None = None,
) -> DataFrame:
    """Documents of the kept posts; `contents` (`row_id, content_html`) joins last and once.

    Spark's size estimate goes by the number of columns and so takes the HTML for small; the
    hint keeps it from broadcasting all of it to the few tasks of the other side.
    """
    fields = ["row_id", *ROW, "id", "title", "published", "updated", "url", "labels", "author_name"]
    posts = ops.published(entries).select(fields).join(kept.select(*ROW, "file_name"), ROW)
    converted = html_to_markdown(posts.join(contents.hint("merge"), "row_id"), overrides=overrides)
    return with_document(converted, classification, extra_metadata).drop("content_html", "row_id")
