"""Writing documents and reports."""

from __future__ import annotations

import uuid
from typing import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").parquet(path)


EXPORTED = "feed_path STRING, entry_index BIGINT, id STRING, title STRING, file_path STRING, error STRING"


SCRATCH = "_exporting"


def export_files(documents: DataFrame, root: str) -> DataFrame:
    """Write `document` to `file_path`, one UTF-8 file per row, and say which failed; stage the result once.

    Paths may be local (a folder all executors share) or URIs. A file is written to a folder of its own below `root`,
    which has to be in the same store, and only then moved to its place, so it is there whole or not at all. A task
    that is run again moves the same files to the same places. `clear_scratch` ends the export: it takes away what
    tasks that were lost have left behind.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors = [_write_file(path, text, f"{root}/{SCRATCH}") for path, text in zip(batch["file_path"], batch["document"])]
            yield batch.drop(columns="document").assign(error=pd.Series(errors, dtype=object, index=batch.index))

    rows = documents.select("feed_path", "entry_index", "id", "title", "file_path", "document")
    return rows.mapInPandas(write, EXPORTED)


def _write_file(path: str, text: str, scratch: str) -> str | None:
    """Why the file could not be written; nothing is left of it then."""
    try:
        system, inner = fs.FileSystem.from_uri(path)
        _, place = fs.FileSystem.from_uri(scratch)
        part = f"{place}/{uuid.uuid4().hex}"
        system.create_dir(place, recursive=True)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        try:
            with system.open_output_stream(part) as out:
                out.write(text.encode("utf-8"))
            system.move(part, inner)
        except Exception:
            if system.get_file_info(part).type != fs.FileType.NotFound:
                system.delete_file(part)
            raise
    except Exception as error:
        return str(error)
    return None


def clear_scratch(root: str) -> None:
    """End an export, once its result has been staged."""
    system, inner = fs.FileSystem.from_uri(f"{root}/{SCRATCH}")
    if system.get_file_info(inner).type != fs.FileType.NotFound:
        system.delete_dir(inner)


def write_issues(exported: DataFrame) -> DataFrame:
    """`file_write_error` issues of failed exports."""
    return exported.where("error IS NOT NULL").select(
        "feed_path", "entry_index", F.lit(102).alias("seq"), F.lit("error").alias("severity"),
        F.lit("file_write_error").alias("issue_type"), F.col("id").alias("post_id"),
        F.col("title").alias("post_title"),
        F.concat(F.lit("Failed to write markdown file '"), "file_path", F.lit("': "), "error").alias("message"),
    )


def write_lines(lines: DataFrame, order: list, path: str) -> None:
    """Ordered text: part files, read in name order, are the report. The sort is distributed."""
    lines.orderBy(*map(F.expr, order)).select("line").write.mode("overwrite").text(path)
