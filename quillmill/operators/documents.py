"""Frontmatter and document text, and the records of what was converted."""

from __future__ import annotations

import json
from functools import reduce
from typing import Any, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions.text import blank_to_null, json_scalar, once, strip

# Fixed value of the document format: the default classification.
CLASSIFICATION = "personal_analysis"
BASE_KEYS = ["title", "date", "url", "labels", "classification", "type", "id"]
OPTIONAL_KEYS = ["updated", "author"]
# Characters JSON leaves as they are but YAML wants escaped, by code point ranges.
UNPRINTABLE = [*range(0x7F, 0xA0), 0x2028, 0x2029, 0xFFFE, 0xFFFF]


def frontmatter_fields(classification: str | Column = CLASSIFICATION) -> dict[str, Column]:
    """Frontmatter values by key, in order; a null one is left out."""
    kind = F.lit(classification) if isinstance(classification, str) else classification
    return {
        "title": F.col("title"),
        "date": F.col("published"),
        "url": F.coalesce("url", F.lit("")),
        "labels": F.coalesce("labels", F.array().cast("array<string>")),
        "classification": kind,
        "type": kind,
        "id": F.col("id"),
        "updated": blank_to_null(F.col("updated")),
        "author": blank_to_null(F.col("author_name")),
    }


def frontmatter_struct(classification: str | Column = CLASSIFICATION) -> Column:
    return F.struct(*[c.alias(key) for key, c in frontmatter_fields(classification).items()])


def frontmatter_text(
    classification: str | Column = CLASSIFICATION, extra: Mapping[str, Any] | Column | None = None
) -> Column:
    """YAML block between ``---`` lines. Scalars are JSON-quoted, which YAML reads back equal.

    `extra` overrides a key in place or appends one: a dict of plain values, the same for
    all posts, or a map<string,string> column.
    """
    lines = {key: _line(key, value) for key, value in frontmatter_fields(classification).items()}
    appended = F.array().cast("array<string>")
    if isinstance(extra, Column):
        entries = F.map_entries(F.map_filter(extra, lambda k, v: ~k.isin(list(lines))))
        more = F.transform(entries, lambda e: F.concat(json_scalar(e["key"]), F.lit(": "), json_scalar(e["value"])))
        appended = F.coalesce(more, appended)
        lines = {
            key: F.when(F.map_contains_key(extra, key), F.concat(F.lit(f"{key}: "), json_scalar(extra[key]))).otherwise(line)
            for key, line in lines.items()
        }
    elif extra:
        lines |= {key: F.lit(f"{json.dumps(key)}: {json.dumps(value, ensure_ascii=False)}") for key, value in extra.items()}
    present = F.filter(F.array(*lines.values()), lambda line: line.isNotNull())
    body = F.array_join(F.concat(present, appended), "\n")
    return F.concat(F.lit("---\n"), _escape_unprintable(body), F.lit("\n---\n"))


def _line(key: str, value: Column) -> Column:
    if key != "labels":
        return F.when(value.isNotNull(), F.concat(F.lit(f"{key}: "), json_scalar(value)))
    items = F.transform(value, lambda label: F.concat(F.lit("\n- "), json_scalar(label)))
    return F.concat(F.lit("labels:"), F.when(F.size(value) == 0, " []").otherwise(F.array_join(items, "")))


def _escape_unprintable(text: Column) -> Column:
    def escaped(whole: Column) -> Column:
        replaced = reduce(lambda c, point: F.replace(c, F.lit(chr(point)), F.lit(f"\\u{point:04x}")), UNPRINTABLE, whole)
        return F.when(whole.rlike(r"[\x7F-\x9F\u2028\u2029\uFFFE\uFFFF]"), replaced).otherwise(whole)

    return once(text, escaped)


def document_text(frontmatter: Column, markdown: Column) -> Column:
    body = once(
        strip(F.coalesce(markdown, F.lit(""))),
        lambda text: F.when(text == "", "\n").otherwise(F.concat(F.lit("\n"), text, F.lit("\n"))))
    return F.concat(frontmatter, body)


def with_document(
    posts: DataFrame, classification: str | Column = CLASSIFICATION, extra: Mapping[str, Any] | Column | None = None
) -> DataFrame:
    """Add `document` to posts that carry their entry fields and `markdown`."""
    return posts.withColumn("document", document_text(frontmatter_text(classification, extra), F.col("markdown")))


def converted_records(
    documents: DataFrame, output_dir: str | Column, classification: str | Column = CLASSIFICATION
) -> DataFrame:
    folder = F.lit(output_dir.rstrip("/")) if isinstance(output_dir, str) else output_dir
    kind = F.lit(classification) if isinstance(classification, str) else classification
    return documents.select(
        "feed_path", "entry_index", F.col("id").alias("post_id"), "title", F.col("published").alias("date"),
        "url", "labels", F.concat(folder, F.lit("/"), F.col("file_name")).alias("file_path"), "file_name",
        kind.alias("classification"),
    )
