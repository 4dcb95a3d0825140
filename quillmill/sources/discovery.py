"""Finding feeds and settings in extracted archives, and joining the two.

Files go by the path they are named with, whatever characters it has; only names are listed.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quillmill.functions.text import once, strip
from quillmill.operators.skew import keyed_join, spread_rows
from quillmill.sources.feeds import feed_path, forgetting, listing, literal_path, small_files
from quillmill.staging import stage, stage_counted

# Fixed values of the archive layout.
TOP_LEVEL = ["feed.atom", "atom.feed"]
ANYWHERE = ["feed.atom", "atom.feed", "*.atom", "*.xml"]
SKIPPED_PREFIX = "theme-"
SKIPPED_FOLDER = "Comments"
SETTINGS = "settings.csv"
SUBDOMAIN_COLUMN = "blog_subdomain"
BASE_URL = "https://%s.blogspot.com"

FEED_NAMES = "{" + ",".join(dict.fromkeys(ANYWHERE)) + "}"
FILE_SCHEME = r"\Afile:/+"
# More columns than a settings file has.
SETTINGS_COLUMNS = 256
# Of these, read as columns, and the characters that the reader holds of a file (by itself a million).
READ_COLUMNS = 64
READ_BUFFER = str(128 * 2**10)
# Files whose state the driver holds at a time, and folders that a task goes into for each it is given.
PORTION = 50_000
FOLDERS = 1_000
LISTED = "path string, size long, folder boolean"


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """`path`, as it is named, and `size` of the files at or below `root` whose names have the pattern.

    Spark's own listing hands the state of every file to the driver, whether its name has the pattern or not. Local
    folders are therefore listed in tasks, into staged tables."""
    folder = _local_folder(spark, root)
    if folder is not None:
        return _files_below(spark, folder, pattern)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    with listing(spark):
        files = files.load(literal_path(root))
    return files.select(feed_path().alias("path"), F.col("length").alias("size"))


def _local_folder(spark: SparkSession, root: str) -> str | None:
    """The path without scheme if it is a folder of the local file system (of one that all executors share)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = system.makeQualified(path).toUri()
    found = whole.getScheme() == "file" and system.exists(path) and system.getFileStatus(path).isDirectory()
    return whole.getPath() if found else None


def _files_below(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Tasks go down from the folders they are given and hand those back that they do not go into, for a next round."""
    folders, rounds = spark.createDataFrame([(root,)], "path STRING"), []
    while not rounds or not folders.isEmpty():
        rounds.append(stage(folders.mapInArrow(_listing(glob_regex(pattern), FOLDERS), LISTED), "listed"))
        folders = spread_rows(rounds[-1].where("folder").select("path"), "path")
    return reduce(DataFrame.unionByName, rounds).where("NOT folder").select("path", "size")


def glob_regex(pattern: str) -> str:
    """A regular expression for a pattern of names, stars, question marks and alternatives."""
    marks = {"{": "(?:", "}": ")", "*": ".*", "?": "."}
    parts, depth = [], 0
    for part in re.split(r"([{},*?])", pattern):
        depth += (part == "{") - (part == "}")
        parts.append("|" if part == "," and depth else marks.get(part, re.escape(part)))
    return rf"(?s)\A{''.join(parts)}\Z"


def _listing(names: str, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows_of(rows: list[tuple[str, int, bool]]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.bool_()]
        columns = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], ["path", "size", "folder"])

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int, bool]] = []
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                for row in _below(folder, re.compile(names), most):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield rows_of(rows)
                        rows = []
        yield rows_of(rows)

    return listing


def _below(folder: str, names: re.Pattern[str], most: int) -> Iterator[tuple[str, int, bool]]:
    """Files in up to `most` folders from this one downwards, but for empty ones, as in Spark, and the folders that are left."""
    todo = [folder]
    while todo:
        most -= 1
        place = todo.pop()
        try:
            found = os.scandir(place)
        except FileNotFoundError:  # gone meanwhile
            continue
        with found:
            for entry in found:
                path = f"{place.rstrip('/')}/{entry.name}"
                if _unseen(entry.name):
                    continue
                if entry.is_dir():
                    if len(todo) < most:
                        todo.append(path)
                    else:
                        yield path, 0, True
                elif not _aside(entry.name) and names.match(entry.name):
                    try:
                        size = entry.stat().st_size
                    except FileNotFoundError:  # gone meanwhile, or a link to nowhere
                        continue
                    if size:
                        yield path, size, False


def _aside(name: str) -> bool:
    """Names of files that Spark does not read."""
    return name.startswith(".") or name.startswith("_") and "=" not in name


def _unseen(name: str) -> bool:
    """Names that Spark does not list, and those that are no text."""
    hidden = _aside(name) or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_common_metadata", "_metadata")) or any("\ud800" <= c <= "\udfff" for c in name)


def discover_feeds(spark: SparkSession, root: str, depth: int = 0) -> DataFrame:
    """`archive, feed_path, size`: the one feed of every archive folder.

    An archive is a folder `depth` levels below `root` (0: the root itself). The first file
    pattern with a match decides; among its matches theme files and comment feeds come last
    and the smallest path wins.
    """
    anchor = re.escape(bare_path(root.rstrip("/"))) + "(?:/[^/]+)" * depth
    files = list_files(spark, root, FEED_NAMES).withColumns({
        "archive": F.regexp_extract("path", rf"\A({anchor})/", 1),
        "inner": F.regexp_replace("path", rf"\A{anchor}/", ""),
    }).where("archive <> ''")
    return candidates(files).groupBy("archive").agg(
        F.min("rank").alias("best"), F.min_by("size", "rank").alias("size")).select(
        "archive", F.col("best.path").alias("feed_path"), "size")


def candidates(files: DataFrame) -> DataFrame:
    """Files (`archive, path, inner`) with the sortable `rank` a feed is chosen by."""
    name = F.element_at(F.split("inner", "/"), -1)
    steps = [(F.col("inner") == top, False) for top in TOP_LEVEL]
    steps += [(name.like(pattern.replace("*", "%")), True) for pattern in ANYWHERE]
    priority: Column = F.lit(None).cast("int")
    for number, (matches, _) in reversed(list(enumerate(steps))):
        priority = F.when(matches, number).otherwise(priority)
    skipped = name.startswith(SKIPPED_PREFIX) | F.array_contains(F.split("path", "/"), SKIPPED_FOLDER)
    return (
        files.withColumn("priority", priority).where("priority IS NOT NULL")
        .withColumn("rank", F.struct(
            "priority", (skipped & (F.col("priority") >= len(TOP_LEVEL))).alias("skipped"), "path"))
    )


def bare_path(path: str) -> str:
    """A local path without its scheme, however that is spelled."""
    return re.sub(FILE_SCHEME, "/", path)


def _settings(spark: SparkSession, paths: Any, **options: str) -> DataFrame:
    """`folder, base_url` from the first line of data of each file; `paths` is one, or a list of the JVM's.

    Files may have their columns in any order, so the names are looked up in each one's own first line. Spark sets its
    CSV reader up anew for each file, at a cost that grows with the square of the columns and with the buffer. So
    files are read with few columns, and a line that may have more is kept as it stands and taken apart afterwards.
    """
    dialect = {"multiLine": "true", "escape": '"'}
    cells = [f"c{n}" for n in range(READ_COLUMNS)]
    with listing(spark):
        reader = spark.read.options(
            **dialect, inputBufferSize=READ_BUFFER, columnNameOfCorruptRecord="whole", **options,
        ).schema(", ".join(f"{c} STRING" for c in [*cells, "whole"]))
        lines = reader.csv(paths) if isinstance(paths, str) else reader._df(reader._jreader.csv(spark._jvm.PythonUtils.toSeq(paths)))
    lines = lines.select(
        feed_path().alias("path"), F.monotonically_increasing_id().alias("line"),
        F.struct(F.array(*cells).alias("cells"), "whole").alias("row"))
    number = F.row_number().over(Window.partitionBy("path").orderBy("line"))
    first = lines.withColumn("number", number).where("number <= 2").groupBy("path").agg(
        F.min_by("row", "number").alias("names"), F.max_by("row", "number").alias("values"), F.count(F.lit(1)).alias("lines"))
    first = first.withColumns({name: _cells(F.col(name), dialect) for name in ("names", "values")})
    at = F.array_position("names", SUBDOMAIN_COLUMN).cast("int") - 1
    name = F.when((F.col("lines") == 2) & (at >= 0), strip(F.get(F.col("values"), at)))
    return first.select(
        _folder(F.col("path")).alias("folder"), F.when(name != "", F.format_string(BASE_URL, name)).alias("base_url"))


def _cells(row: Column, dialect: dict[str, str]) -> Column:
    """All cells of a line: those that were read, or those of the whole line where there may be more."""
    whole = row["whole"]
    commas = F.length(whole) - F.length(F.replace(whole, F.lit(","), F.lit("")))
    names = [f"c{n}" for n in range(SETTINGS_COLUMNS)]
    # How the lines of the file end is not known here: carriage returns end none, and in a cell they become line feeds.
    parsed = F.from_csv(whole, ", ".join(f"{n} STRING" for n in names), {**dialect, "lineSep": "\n"})
    taken_apart = F.transform(
        once(parsed, lambda line: F.array(*[line[n] for n in names])), lambda cell: F.regexp_replace(cell, "\r\n?", "\n"))
    return F.when(commas >= READ_COLUMNS, taken_apart).otherwise(row["cells"])


def read_settings(spark: SparkSession, root: str) -> DataFrame:
    """`folder, base_url` of every settings file below `root` (one small row per blog).

    The reader's files are known to the driver, so a local folder's are read, and staged, in portions of a fixed size."""
    if _local_folder(spark, root) is None:
        return _settings(spark, literal_path(root), recursiveFileLookup="true", pathGlobFilter=SETTINGS)
    files, number = stage_counted(list_files(spark, root, SETTINGS).select("path"), "settings_files")
    portions = math.ceil(number / PORTION)
    found = spark.createDataFrame([], "folder STRING, base_url STRING")
    for portion in range(portions):
        with forgetting(spark):
            paths = _named(files.where(F.pmod(F.xxhash64("path"), F.lit(portions)) == portion))
            some = _settings(spark, paths, recursiveFileLookup="true")
        if portions == 1:
            return some
        with small_files(spark):
            found = found.unionByName(stage(some, "settings"))
    return found


def _named(files: DataFrame) -> Any:
    """The local paths as a list of the JVM's, as Spark's readers take them: with a scheme, and no patterns."""
    escaped = F.regexp_replace("path", r"([{}\[\]*?\\])", r"\\$1")
    encoder = files.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING()
    return getattr(files.select(F.concat(F.lit("file:"), escaped))._jdf, "as")(encoder).collectAsList()


def read_settings_at(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The same for given folders only; a folder without a settings file is left out."""
    found = spark.createDataFrame([], "folder STRING, base_url STRING")
    for folder in folders:
        try:
            found = found.unionByName(_settings(spark, f"{literal_path(folder)}/{SETTINGS}"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*\z", "")


def with_base_url(feeds: DataFrame, settings: DataFrame, total: int) -> DataFrame:
    """`base_url` per feed from the settings file beside it, else from the one in the folder
    above. A file that is there but says nothing still hides the one above.

    The settings are staged first: both sides and the counts of hot keys use them, but files are opened once."""
    with small_files(settings.sparkSession):
        settings = stage(settings, "settings")
    placed = feeds.withColumn("near", _folder(F.col("feed_path"))).withColumn("above", _folder(F.col("near")))

    def side(key: str) -> DataFrame:
        return settings.select(
            F.col("folder").alias(key), F.struct(F.col("base_url").alias("url")).alias(f"{key}_settings"))

    joined = keyed_join(placed, side("near"), ["near"], "left", total)
    joined = keyed_join(joined, side("above"), ["above"], "left", total)
    chosen = F.when(F.col("near_settings").isNotNull(), F.col("near_settings.url")).otherwise(F.col("above_settings.url"))
    return joined.select(*feeds.columns, chosen.alias("base_url"))
