"""SHA-256 of input files, taken before and after a run."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.operators.skew import spread_rows
from quillmill.sources.feeds import feed_path, listing, literal_path

# What a task holds of a file.
CHUNK_BYTES = 2**20
MUTATION_MESSAGE = "CRITICAL: Input feed file hash changed during execution! File was unexpectedly modified."
FINGERPRINT = "feed_path string, size bigint, changed_at timestamp, sha256 string"


def fingerprints(spark: SparkSession, path: str, feeds: DataFrame | None = None, names: str = "*") -> DataFrame:
    """`feed_path, size, changed_at, sha256` of every file at or below `path` (a name, not a pattern), whatever its size.

    `feeds` (`feed_path`) are the files to hash, if not all; `names` is a pattern that their names have. Only names
    are listed by Spark; a task opens its files one after the other and hashes them piece by piece, through the
    file systems of Arrow, so neither a task nor the driver ever holds a file.
    """
    with listing(spark):
        files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=names).load(literal_path(path))
    files = files.select(
        feed_path().alias("feed_path"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("changed_at"))
    if feeds is not None:
        files = files.join(feeds.select("feed_path"), "feed_path", "left_semi")
    return spread_rows(files, "path").mapInArrow(_hashed, FINGERPRINT)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = pa.array([file_sha256(path) for path in batch.column("path").to_pylist()], pa.string())
        columns = [batch.column(name) for name in ("feed_path", "size", "changed_at")]
        yield pa.RecordBatch.from_arrays([*columns, hashes], ["feed_path", "size", "changed_at", "sha256"])


def file_sha256(path: str, chunk: int = CHUNK_BYTES) -> str | None:
    """Hash of a file as a stream; null if it has vanished."""
    if path.startswith("file:"):  # as it is named, not percent-encoded
        system, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        system, inner = fs.FileSystem.from_uri(path)
    digest = hashlib.sha256()
    try:
        with system.open_input_stream(inner) as stream:
            while piece := stream.read(chunk):
                digest.update(piece)
    except FileNotFoundError:
        return None
    return digest.hexdigest()


def compare_fingerprints(before: DataFrame, after: DataFrame) -> DataFrame:
    """`feed_path, sha256` (as before) and `unmodified`; a vanished or new file is modified."""
    old, new = before.alias("old"), after.alias("new")
    same = F.col("old.sha256").eqNullSafe(F.col("new.sha256")) & F.col("old.size").eqNullSafe(F.col("new.size"))
    both = F.col("old.feed_path").isNotNull() & F.col("new.feed_path").isNotNull()
    return old.join(new, F.col("old.feed_path") == F.col("new.feed_path"), "full_outer").select(
        F.coalesce("old.feed_path", "new.feed_path").alias("feed_path"),
        F.col("old.sha256").alias("sha256"), (both & same & F.col("old.sha256").isNotNull()).alias("unmodified"),
    )


def mutation_issues(compared: DataFrame) -> DataFrame:
    """One `file_mutation_error` per modified file; it belongs to no entry."""
    nothing = F.lit(None).cast("string")
    return compared.where("NOT unmodified").select(
        "feed_path", F.lit(None).cast("bigint").alias("entry_index"), F.lit(0).alias("seq"),
        F.lit("error").alias("severity"), F.lit("file_mutation_error").alias("issue_type"),
        nothing.alias("post_id"), nothing.alias("post_title"), F.lit(MUTATION_MESSAGE).alias("message"),
    )
