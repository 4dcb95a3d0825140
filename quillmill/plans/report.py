"""Counts and reports per feed.

Reports are tables of lines with sort keys, written by a distributed sort, so a feed with
most of the entries needs no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions.text import capitalized, escape_bars, json_scalar
from quillmill.operators.skew import keyed_join

# An issue without an entry comes last.
LINE_ORDER = ["feed_path", "section", "sort", f"coalesce(entry_index, {2**63 - 1})", "seq"]
# Fixed values of the report format.
TITLE = "# Blogger / Blogspot Ingestion Report"
METRICS = [
    ("Total Feed Entries", "total_entries"),
    ("Published Posts Found", "published_posts_found"),
    ("Successfully Converted", "converted_count"),
    ("Skipped Entries", "skipped_count"),
    ("Duplicate Entries", "duplicate_count"),
    ("Conversion Issues / Warnings", "issue_count"),
]
BREAKDOWN_TABLE = ("### Skipped Entries Breakdown", ["Category", "Count"])
DUPLICATES_TABLE = ("## Duplicates Detected", ["Title", "Post ID", "Reason"])
ISSUES_TABLE = ("## Conversion Issues & Warnings", ["Severity", "Issue Type", "Post / Title", "Details"])
CONVERTED_TABLE = ("## Converted Posts", ["Date", "Title", "Output File", "Labels"])


def skipped_breakdown(skipped: DataFrame) -> DataFrame:
    """`feed_path, kind, count`."""
    return skipped.groupBy("feed_path", "kind").agg(F.count("*").alias("count"))


def breakdown_map(breakdown: DataFrame) -> DataFrame:
    """`feed_path, skipped_breakdown` as a map of all kinds of a feed."""
    return breakdown.groupBy("feed_path").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("kind", "count")))).alias("skipped_breakdown"))


def entry_counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("feed_path").agg(
        F.count("*").alias("total_entries"),
        F.count_if(F.col("route") == "published").alias("published_posts_found"),
        F.count_if(F.col("route") == "skipped").alias("skipped_count"),
    )


def summary(
    feeds: DataFrame, entries: DataFrame, converted: DataFrame, duplicates: DataFrame, issues: DataFrame,
    breakdown: DataFrame, *, output_dir: str | Column, duration_seconds: float | None = None,
) -> DataFrame:
    """One row per feed. `feeds` has `feed_path, sha256, unmodified`."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("feed_path").agg(F.count("*").alias(name))

    joined = feeds
    for side in (
        entry_counts(entries), counted(converted, "converted_count"), counted(duplicates, "duplicate_count"),
        counted(issues, "issue_count"), breakdown_map(breakdown),
    ):
        joined = joined.join(side, "feed_path", "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)
    return joined.select(
        F.col("feed_path").alias("input_file"),
        (F.lit(output_dir) if isinstance(output_dir, str) else output_dir).alias("output_dir"),
        F.col("sha256").alias("input_file_hash_sha256"), F.col("unmodified").alias("input_file_unmodified"),
        *map(zero, ["total_entries", "published_posts_found", "converted_count", "skipped_count"]),
        F.coalesce("skipped_breakdown", F.create_map().cast("map<string,bigint>")).alias("skipped_breakdown"), zero("duplicate_count"), zero("issue_count"),
        F.round(F.lit(duration_seconds).cast("double"), 3).alias("duration_seconds"),
    )


def totals(entries: DataFrame) -> DataFrame:
    """Entry counts per feed, and over all feeds where `feed_path` is null."""
    return entries.rollup("feed_path").agg(
        F.count("*").alias("total_entries"),
        F.count_if(F.col("route") == "published").alias("published_posts_found"),
        F.count_if(F.col("route") == "skipped").alias("skipped_count"),
    )


def all_issues(*sources: DataFrame) -> DataFrame:
    columns = ["feed_path", "entry_index", "seq", "severity", "issue_type", "post_id", "post_title", "message"]
    result = sources[0].select(columns)
    for more in sources[1:]:
        result = result.unionByName(more.select(columns))
    return result


def duplicate_issues(duplicates: DataFrame) -> DataFrame:
    return duplicates.select(
        "feed_path", "entry_index", F.lit(100).alias("seq"), F.lit("warning").alias("severity"),
        F.lit("duplicate_post").alias("issue_type"), "post_id", F.col("title").alias("post_title"),
        F.col("reason").alias("message"),
    )


# --- reports -------------------------------------------------------------------------------


def _rows(
    df: DataFrame, section: int, line: Column, *, sort: str = "''", entry: str = "0", seq: str = "0"
) -> DataFrame:
    keys = [f"CAST({sort} AS STRING) AS sort", f"CAST({entry} AS BIGINT) AS entry_index", f"CAST({seq} AS INT) AS seq"]
    return df.select("feed_path", F.lit(section).alias("section"), *map(F.expr, keys), line.alias("line"))


def _fixed(summary: DataFrame, section: int, lines: list, condition: Column | None = None) -> DataFrame:
    """The same lines for every feed (that meets the condition)."""
    feeds = summary if condition is None else summary.where(condition)
    texts = F.array(*[F.lit(line) if isinstance(line, str) else line for line in lines])
    return feeds.select(
        F.col("input_file").alias("feed_path"), F.lit(section).alias("section"), F.lit("").alias("sort"),
        F.lit(0).cast("bigint").alias("entry_index"), F.posexplode(texts).alias("seq", "line"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _bars(*cells: Column | str) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.array(*cells), " | "), F.lit(" |"))


def markdown_lines(
    summary: DataFrame, breakdown: DataFrame, duplicates: DataFrame, issues: DataFrame, converted: DataFrame,
    *, generated_on: str | None = None,
) -> DataFrame:
    """Lines of the Markdown report, to be sorted by `LINE_ORDER`."""
    head = [
        TITLE, "",
        *([f"**Generated on:** {generated_on}"] if generated_on else []),
        F.format_string("**Input File:** `%s`", "input_file"),
        F.format_string("**Output Directory:** `%s`", "output_dir"),
        F.format_string("**Execution Duration:** %.2fs", F.coalesce("duration_seconds", F.lit(0.0))),
        F.concat(F.lit("**Original Archive Unmodified:** "), F.when(F.col("input_file_unmodified"), "✅ Yes").otherwise("❌ No")),
        "", "## Summary Metrics", "", "| Metric | Count |", "| :--- | :--- |",
        *[F.format_string(f"| **{title}** | %d |", name) for title, name in METRICS],
        "",
    ]

    def table(section: int, title: str, columns: list[str], condition: Column | None) -> list[DataFrame]:
        top = [title, "", "| " + " | ".join(columns) + " |", "| " + " | ".join([":---"] * len(columns)) + " |"]
        return [_fixed(summary, section, top, condition), _fixed(summary, section + 2, [""], condition)]

    ticked = lambda c: F.concat(F.lit("`"), c, F.lit("`"))
    named = F.coalesce(F.expr("nullif(post_title, '')"), F.expr("nullif(post_id, '')"), F.lit("N/A"))
    return _union([
        _fixed(summary, 0, head),
        *table(10, *BREAKDOWN_TABLE, F.col("skipped_count") > 0),
        _rows(breakdown, 11, _bars(capitalized(F.col("kind")), F.col("count").cast("string")), sort="kind"),
        *table(20, *DUPLICATES_TABLE, F.col("duplicate_count") > 0),
        _rows(duplicates, 21, _bars(escape_bars(F.col("title")), ticked(F.col("post_id")), F.col("reason")), entry="entry_index"),
        *table(30, *ISSUES_TABLE, F.col("issue_count") > 0),
        _rows(issues, 31, _bars(F.upper("severity"), ticked(F.col("issue_type")), escape_bars(named),
                                escape_bars(F.col("message"))), entry="entry_index", seq="seq"),
        *table(40, *CONVERTED_TABLE, None),
        _rows(converted, 41, _bars(F.left("date", F.lit(10)), escape_bars(F.col("title")), ticked(F.col("file_name")),
                                   F.when(F.size("labels") > 0, F.array_join("labels", ", ")).otherwise("-")), entry="entry_index"),
    ])


def json_lines(
    summary: DataFrame, breakdown: DataFrame, duplicates: DataFrame, issues: DataFrame, converted: DataFrame,
    skipped: DataFrame, total: int,
) -> DataFrame:
    """Lines of the JSON report (one object per feed), to be sorted by `LINE_ORDER`.

    An element is one line; every element but the first of its list starts with a comma.
    """
    plain = [
        "input_file", "output_dir", "input_file_hash_sha256", "input_file_unmodified", "total_entries",
        "published_posts_found", "converted_count", "skipped_count", "duplicate_count", "issue_count",
        "duration_seconds",
    ]
    as_json = lambda names: F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    facts = F.array(*[F.concat(F.lit(f'    "{name}": '), json_scalar(F.col(name)), F.lit(",")) for name in plain])
    opening = F.concat(F.array(F.lit("{"), F.lit('  "summary": {')), facts, F.array(F.lit('    "skipped_breakdown": {')))
    lists = [
        (20, "converted_posts", converted,
         ["post_id", "title", "date", "url", "labels", "file_path", "file_name", "classification"]),
        (30, "skipped_entries", skipped, ["post_id", "title", "kind", "reason"]),
        (40, "duplicates", duplicates, ["post_id", "title", "url", "reason", "first_seen_file"]),
        (50, "issues", issues, ["severity", "issue_type", "post_id", "post_title", "message"]),
    ]
    kinds = _rows(breakdown, 10, F.concat(json_scalar(F.col("kind")), F.lit(": "), F.col("count").cast("string")),
                  sort="kind")
    elements = [kinds]
    frame = [_fixed_array(summary, 0, opening), _fixed(summary, 11, ["    }", "  },"])]
    for section, name, rows, columns in lists:
        seq = "seq" if "seq" in rows.columns else "0"
        elements.append(_rows(rows, section + 1, as_json(columns), entry="entry_index", seq=seq))
        frame += [
            _fixed(summary, section, [f'  "{name}": [']),
            _fixed(summary, section + 2, ["  ]" if name == "issues" else "  ],"]),
        ]
    frame.append(_fixed(summary, 60, ["}"]))
    listed = _union(elements)
    place = F.struct("sort", F.coalesce("entry_index", F.lit(2**63 - 1)).alias("entry_index"), "seq")
    heads = listed.groupBy("feed_path", "section").agg(F.min(place).alias("_head"))
    marked = keyed_join(listed, heads, ["feed_path", "section"], "left", total)
    comma = F.when(place == F.col("_head"), "     ").otherwise("    ,")
    return _union(frame).unionByName(marked.withColumn("line", F.concat(comma, F.col("line"))).drop("_head"))


def _fixed_array(summary: DataFrame, section: int, lines: Column) -> DataFrame:
    return summary.select(
        F.col("input_file").alias("feed_path"), F.lit(section).alias("section"), F.lit("").alias("sort"),
        F.lit(0).cast("bigint").alias("entry_index"), F.posexplode(lines).alias("seq", "line"),
    )
