"""Feed scan: archive files -> one raw row per entry, and the entry ordinals.

A feed is cut at its closing entry tags wherever Spark splits the file, so one archive of any size is read by
many tasks. Whether a cut is a real one depends on what stands before it: the tag may be inside a comment, a CDATA
section or a processing instruction, or belong to an entry within an entry. Each piece between two cuts therefore
yields a map: for every lexical state it may begin in, the state it ends in, and by how many entries it is deeper
then. The maps of a split are composed in order, then those of a feed's splits, and each split knows where it starts.

Where all pieces of a split begin and end in plain text, outside all entries, they are read as they are: no text is
shuffled. Only the pieces of other splits are put together again, by the count of real ends before them.

`splittable=False` hands every file to one task, which holds it whole (2 GB at most). Both ways give the same
entries; entries within entries are told apart by the split reader only.

Every element is declared as an array, so a tag given twice keeps all its values. `tags` has the order of those
children whose order among different tags matters; it is null where it cannot. The text of content with child
elements is what stands before the first of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from functools import reduce
from operator import or_

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quillmill.functions.text import once
from quillmill.operators.skew import keyed_join, spread_rows
from quillmill.staging import stage, stage_counted

TEXT = "STRUCT<_VALUE: STRING, _type: STRING>"
RAW_ENTRY = ", ".join(
    [
        "id ARRAY<STRING>",
        f"title ARRAY<{TEXT}>",
        f"content ARRAY<{TEXT}>",
        "type ARRAY<STRING>",
        "status ARRAY<STRING>",
        "published ARRAY<STRING>",
        "created ARRAY<STRING>",
        "updated ARRAY<STRING>",
        "trashed ARRAY<STRING>",
        "filename ARRAY<STRING>",
        "category ARRAY<STRUCT<_scheme: STRING, _term: STRING, _VALUE: STRING>>",
        "link ARRAY<STRUCT<_rel: STRING, _type: STRING, _href: STRING, _VALUE: STRING>>",
        "author ARRAY<STRUCT<name: ARRAY<STRING>, email: ARRAY<STRING>>>",
        "control ARRAY<STRUCT<draft: ARRAY<STRING>>>",
        "`in-reply-to` ARRAY<STRUCT<_ref: STRING, _VALUE: STRING>>",
        "inReplyTo ARRAY<STRING>",
    ]
)
XML_OPTIONS = {
    "rowTag": "entry",
    "ignoreNamespace": "true",
    "ignoreSurroundingSpaces": "false",
    "mode": "FAILFAST",
}
CUT = "</entry>"
CDATA = r"<!\[CDATA\[.*?\]\]>"
SECTION = rf"<!--.*?-->|{CDATA}|<\?.*?\?>"
# Lexical states other than plain text: how a section opens and how it closes.
SECTIONS = [("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?", "?>")]
UNCLOSED = r"<!--|<!\[CDATA\[|<\?"
ATTRIBUTES = r"""(?:\s(?:[^<>"'/]++|/(?!>)|"[^"]*"|'[^']*')*+)?"""
ENTRY_NAME = r"(?:[\w.-]+:)?entry"
# An entry, or a section outside of entries.
ENTRY = rf"(?s){SECTION}|<({ENTRY_NAME}){ATTRIBUTES}(?:/>|>(?:[^<]++|{SECTION}|<(?!/\1\s*>))*+</\1\s*>)"
BEFORE_ENTRY = rf"(?s)\A(?:[^<]++|{SECTION}|<(?!{ENTRY_NAME}[\s>/]))*+"
# Content with child elements: its text is what stands before the first of them (groups 2 and 4 are
# content without its children). CDATA sections elsewhere match as group 1 and stay as they are.
MIXED_CONTENT = (
    rf"(?s)({CDATA})"
    r"""|(<((?:[\w.-]+:)?content)(?:\s(?:[^>"']++|"[^"]*"|'[^']*')*+)?(?<!/)>"""
    rf"(?:[^<]++|{CDATA})*+)<(?![/!?])(?!\3[\s>/])(?:[^<]++|{CDATA}|<(?!/?\3[\s>/]))*+(</\3\s*>)"
)
# Children whose order among different tags matters, and the tags of an entry one after the other.
ORDERED = ["published", "created", "category", "in-reply-to", "inReplyTo"]
ORDER_MATTERS = ["created", "in-reply-to", "inReplyTo"]
TAG = rf"(?s){SECTION}|</?[\w:.-]+{ATTRIBUTES}/?>"
# Folder names are just names, whatever they look like.
PLAIN_FOLDERS = {"recursiveFileLookup": "true"}
SPLIT = ["feed_path", "block"]
PIECE = ["feed_path", "block", "piece"]
LISTED_BYTES = 64 * 2**20
"""Lists of feeds or of splits up to this size are sent to all tasks; larger ones are joined by a shuffle."""
SMALL_BYTES = 8 * 2**20
"""Listed feeds up to this size are opened one by one; in larger ones Spark's text source makes the splits."""
# Stores that tasks open files of by themselves, and files that the text source would unpack.
OPENED = r"\A(?:/|hdfs://|s3://|gs://)"
PACKED = r"\.(?:gz|bz2|deflate|lz4|snappy|zst)\z"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
TASKS_PER_CORE = 8
OPEN_COST = "spark.sql.files.openCostInBytes"
SMALL_OPEN_COST = str(512 * 2**10)
FILE_CACHE = "spark.sql.hive.filesourcePartitionFileCacheSize"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def listing(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, Spark lists many folders in a few tasks for each core instead of one task for each folder."""
    before, wanted = int(spark.conf.get(LISTING_TASKS)), TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return _setting(spark, LISTING_TASKS, str(min(before, wanted)))


def small_files(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, a scan that runs puts up to 256 tiny files into a task instead of 32."""
    return _setting(spark, OPEN_COST, SMALL_OPEN_COST)


def forgetting(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, the driver does not keep the state of files for readers to come."""
    return _setting(spark, FILE_CACHE, "0")


def literal_path(path: str) -> str:
    """A path to load that has the characters of a pattern in its name."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def plain_path(path: Column) -> Column:
    """The path of a file as it is named: not percent-encoded, and without a scheme if it is local."""
    decoded = F.url_decode(F.regexp_replace(path, r"\+", "%2B"))
    return F.regexp_replace(decoded, r"\Afile:/+", "/")


def feed_path() -> Column:
    return plain_path(F.col("_metadata.file_path"))


def read_feeds(
    spark: SparkSession, path: str, feeds: DataFrame | None = None, *, splittable: bool = True, encoding: str = "UTF-8",
    names: str = "*",
) -> DataFrame:
    """Raw entries of the files at or below `path` (a name, not a pattern): `feed_path`, the place of the entry
    (`block, piece, sub`), a key `row_id`, the elements and `tags`. Stage them before they are used more than once.

    `feeds` (`feed_path`, staged) are the files to read, if not all; `names` is a pattern that their names have. With
    their `size`, too, small ones are opened by their names, and others at the path are not touched for them.
    """
    if splittable and encoding.upper().startswith(("UTF-16", "UTF-32")):
        raise ValueError(f"A feed in {encoding} cannot be cut by bytes; read it with splittable=False.")
    opened = None
    if feeds is not None and splittable and "size" in feeds.columns:
        small = (F.col("size") <= SMALL_BYTES) & F.col("feed_path").rlike(OPENED) & ~F.col("feed_path").rlike(PACKED)
        opened, feeds = spread_rows(feeds.where(small).select("feed_path"), "feed_path"), feeds.where(~small)
        opened = opened.mapInArrow(_cut_files, PIECES).withColumn("value", F.col("value").cast("string"))
    if opened is not None and feeds.isEmpty():
        read = opened
    else:
        read = _scanned_files(spark, path, feeds, splittable, names)
        read = read if opened is None else read.unionByName(opened)
    if encoding.upper() != "UTF-8":
        # The text source hands the bytes on as they are.
        read = read.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    read = read.withColumn("value", _declared(F.col("value"), encoding))
    return _parsed(_split_entries(read) if splittable else _entries_of(read, F.col("value")))


def _scanned_files(spark: SparkSession, path: str, feeds: DataFrame | None, splittable: bool, names: str) -> DataFrame:
    """`feed_path, block, piece, value` by Spark's text source."""
    with listing(spark):
        text = spark.read.options(**PLAIN_FOLDERS, pathGlobFilter=names).text(
            literal_path(path), wholetext=not splittable, lineSep=CUT if splittable else None)
    read = text.select(
        feed_path().alias("feed_path"), F.expr("_metadata.file_block_start AS block"),
        F.monotonically_increasing_id().alias("piece"), "value")
    return read if feeds is None else _listed(read, feeds.select("feed_path"), ["feed_path"], "left_semi")


PIECES = "feed_path string, block long, piece long, value binary"


def _cut_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same of small files, one at a time."""
    for batch in batches:
        for path in batch.column("feed_path").to_pylist():
            pieces = cut_bytes(_file_bytes(path))
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(pieces), pa.string()), pa.array([0] * len(pieces), pa.int64()),
                 pa.array(range(len(pieces)), pa.int64()), pa.array(pieces, pa.binary())],
                ["feed_path", "block", "piece", "value"])


def _file_bytes(path: str) -> bytes:
    system, inner = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    with system.open_input_stream(inner) as stream:
        return stream.read()


def cut_bytes(data: bytes) -> list[bytes]:
    """Pieces as the text source makes them: without a byte order mark, and nothing behind a cut at the end."""
    pieces = data.removeprefix(b"\xef\xbb\xbf").split(CUT.encode())
    return pieces if pieces[-1] else pieces[:-1]


def _listed(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Rows that a list names, or does not name."""
    keys = stage(keys, "listed")
    size = keys.agg(F.sum(F.length(on[0]) + 16)).first()[0] or 0
    return rows.join(F.broadcast(keys) if size <= LISTED_BYTES else keys, on, how)


def _declared(value: Column, encoding: str) -> Column:
    """The text itself, or an error where it declares another encoding."""
    declared = F.regexp_extract(value, r"""\A\W*<\?xml[^>]*?\sencoding\s*=\s*["']([^"']+)""", 1)
    other = F.concat(
        F.lit("The feed declares another encoding; give it as `encoding`: "), declared, F.lit(" "), F.col("feed_path"))
    right = F.when(F.upper(declared).isin("", encoding.upper()), value).otherwise(F.raise_error(other).cast("string"))
    return F.when(value.contains("<?xml"), right).otherwise(value)


# --- pieces and the states they begin in -------------------------------------------------------------


def _scanned(text: Column) -> Column:
    """`state, depth` behind a piece that begins in plain text; a cut that is a real one closes an entry."""
    def behind(before: Column, state: Column) -> Column:
        opened = F.regexp_count(before, F.lit(rf"<{ENTRY_NAME}{ATTRIBUTES}>"))
        closed = F.regexp_count(before, F.lit(rf"</{ENTRY_NAME}\s*>")) + (state == 0).cast("int")
        return F.struct(state.alias("state"), (opened - closed).alias("depth"))

    def unclosed(bare: Column) -> Column:
        return once(F.regexp_extract(bare, UNCLOSED, 0), lambda mark: behind(
            F.when(mark == "", bare).otherwise(F.call_function("substring_index", bare, mark, F.lit(1))),
            F.array_position(F.array(*[F.lit(opening) for opening, _ in SECTIONS]), mark).cast("int")))

    marked = reduce(or_, [text.contains(opening) for opening, _ in SECTIONS])
    return F.when(marked, once(F.regexp_replace(text, rf"(?s){SECTION}", ""), unclosed)).otherwise(behind(text, F.lit(0)))


def _state_map(text: Column) -> Column:
    """For each state that the piece may begin in, `state, depth` behind it."""
    rests = [text]
    for _, closing in SECTIONS:
        at = F.instr(text, closing)
        rests.append(F.when(at > 0, F.substr(text, at + F.lit(len(closing)))))
    return F.transform(F.array(*rests), lambda rest, state: F.when(
        rest.isNull(), F.struct(state.alias("state"), F.lit(0).alias("depth"))).otherwise(_scanned(rest)))


MAP = "array<struct<state: int, depth: int>>"


def _composed(table: pa.Table) -> pa.Table:
    """The map of one split from those of its pieces."""
    table = table.sort_by("piece")
    states, depths = list(range(len(SECTIONS) + 1)), [0] * (len(SECTIONS) + 1)
    for step in table["map"].to_pylist():
        for start, state in enumerate(states):
            depths[start] += step[state]["depth"]
            states[start] = step[state]["state"]
    found = [{"state": state, "depth": depth} for state, depth in zip(states, depths)]
    kind = pa.list_(pa.struct([("state", pa.int32()), ("depth", pa.int32())]))
    return pa.table({**{name: table[name][:1] for name in SPLIT}, "map": pa.array([found], kind)})


def _started(splits: pd.DataFrame) -> pd.DataFrame:
    """The state in which each split of one feed begins; one row for each split."""
    splits = splits.sort_values("block", ignore_index=True)
    state, depth, states, depths = 0, 0, [], []
    for step in splits["map"]:
        states.append(state)
        depths.append(depth)
        depth += step[state]["depth"]
        state = step[state]["state"]
    return splits[SPLIT].assign(state=states, depth=depths)


def _runs(table: pa.Table) -> pa.Table:
    """For the pieces of one split: real ends before each, whether it is one itself, and whether it is complete."""
    table = table.sort_by("piece")
    state, depth, ends = table["state"][0].as_py(), table["depth"][0].as_py(), 0
    before, closed, whole, nested = [], [], [], []
    for step in table["map"].to_pylist():
        outside = state == 0 and depth <= 0
        depth += step[state]["depth"]
        state = step[state]["state"]
        before.append(ends)
        closed.append(state == 0 and depth <= 0)
        whole.append(outside and closed[-1])
        nested.append(state == 0 and depth > 0)
        ends += closed[-1]
    return pa.table({
        **{name: table[name] for name in PIECE}, "run": pa.array(before, pa.int64()), "closed": pa.array(closed),
        "whole": pa.array(whole), "nested": pa.array(nested)})


def _split_entries(pieces: DataFrame) -> DataFrame:
    """Entries of pieces that were cut at every closing entry tag, real or not."""
    cut = F.concat("value", F.lit(CUT))
    # Files are opened once; whatever follows reads the staged pieces.
    staged = stage(pieces.select(*PIECE, "value", _state_map(F.col("value")).alias("map")), "pieces")
    pieces, maps = staged.select(*PIECE, "value"), staged.select(*PIECE, "map")
    plain = F.col("map")[0]
    odd = (plain["state"] != 0) | (plain["depth"] != 0)
    # What follows the last entry of a feed closes none.
    splits = maps.groupBy(SPLIT).agg(
        F.count_if(odd).alias("odd"), F.max_by(plain, "piece").alias("last"))
    splits = splits.withColumn(
        "odd", F.col("odd") > F.when((F.col("last.state") == 0) & (F.col("last.depth") == -1), 1).otherwise(0))
    odd_feeds, number = stage_counted(splits.where("odd").select("feed_path").distinct(), "odd_feeds")
    if not number:
        return _entries_of(pieces, cut)

    maps = _listed(maps, odd_feeds, ["feed_path"], "left_semi")
    composed = stage(maps.groupBy(SPLIT).applyInArrow(_composed, f"feed_path string, block long, map {MAP}"), "split_maps")
    starts = composed.groupBy("feed_path").applyInPandas(_started, "feed_path string, block long, state int, depth int")
    starts = stage(starts.join(splits.select(*SPLIT, "odd"), SPLIT).where("odd OR state <> 0 OR depth > 0"), "odd_splits")
    runs = maps.join(starts, SPLIT).groupBy(SPLIT).applyInArrow(
        _runs, "feed_path string, block long, piece long, run long, closed boolean, whole boolean, nested boolean")
    runs = stage(runs, "runs")
    earlier = Window.partitionBy("feed_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = runs.groupBy(SPLIT).agg(F.count_if("closed").alias("ends")).select(
        *SPLIT, F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("ends_before"))
    runs = runs.join(ends, SPLIT).withColumn("run", F.col("run") + F.col("ends_before")).drop("ends_before", "closed")

    clear = _listed(pieces, starts.select(SPLIT), SPLIT, "left_anti")
    odd_pieces = _listed(pieces, starts.select(SPLIT), SPLIT, "left_semi").join(runs, PIECE)
    parts = F.array_sort(F.collect_list(F.struct("block", "piece", "value")))
    joined = odd_pieces.where("NOT whole").groupBy("feed_path", "run").agg(parts.alias("parts"), F.max("nested").alias("nested"))
    joined = joined.select(
        "feed_path", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["piece"].alias("piece"),
        F.array_join(F.col("parts")["value"], CUT).alias("value"), "nested")
    # An entry that holds others ends where its run does.
    outer = joined.where("nested").withColumn("fragment", F.regexp_replace(cut, BEFORE_ENTRY, ""))
    found = _entries_of(clear, cut).unionByName(_entries_of(odd_pieces.where("whole"), cut)).unionByName(
        _entries_of(joined.where("NOT nested"), cut))
    return found.unionByName(outer.where("fragment <> ''").select(*PIECE, F.lit(0).alias("sub"), "fragment"))


def _entries_of(pieces: DataFrame, text: Column) -> DataFrame:
    """The entries that a text holds, one after the other."""
    found = F.filter(F.regexp_extract_all(text, F.lit(ENTRY), F.lit(0)), lambda x: ~x.startswith("<!") & ~x.startswith("<?"))
    return pieces.select(*PIECE, F.posexplode(found).alias("sub", "fragment"))


# --- one entry ------------------------------------------------------------------------------------------


def _tag_order(fragment: Column) -> Column:
    """Names of the children in `ORDERED`, in the order in which they stand: the tags, folded from left to right."""
    opened = lambda tag: ~tag.startswith("</")
    name = lambda tag: F.regexp_extract(tag, r"\A<(?:[\w.-]+:)?([\w.-]+)", 1)
    tags = F.filter(F.regexp_extract_all(fragment, F.lit(TAG), F.lit(0)), lambda tag: ~tag.rlike(r"\A<[!?]"))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("names"))

    def step(state: Column, tag: Column) -> Column:
        child = opened(tag) & (state["depth"] == 1) & name(tag).isin(*ORDERED)
        deeper = F.when(~opened(tag), -1).when(tag.endswith("/>"), 0).otherwise(1)
        return F.struct(
            (state["depth"] + deeper).alias("depth"),
            F.when(child, F.array_append(state["names"], name(tag))).otherwise(state["names"]).alias("names"))

    matters = F.lit(False)
    for mark in ORDER_MATTERS:
        matters = matters | fragment.contains(mark)
    return F.when(matters, F.aggregate(tags, start, step, lambda state: state["names"]))


def _parsed(entries: DataFrame) -> DataFrame:
    # Spark keeps only the text behind a comment; without comments and instructions the text is whole.
    bare = F.regexp_replace("fragment", rf"(?s)({CDATA})|{SECTION}", "$1")
    marked = F.col("fragment").contains("<!--") | F.col("fragment").contains("<?")
    fragment = F.when(marked, bare).otherwise(F.col("fragment"))
    parsed = F.from_xml(F.regexp_replace("fragment", MIXED_CONTENT, "$1$2$4"), RAW_ENTRY, XML_OPTIONS)
    return entries.withColumn("fragment", fragment).select(
        *PIECE, "sub", F.monotonically_increasing_id().alias("row_id"), _tag_order(F.col("fragment")).alias("tags"),
        parsed.alias("entry"),
    ).select(*PIECE, "sub", "row_id", "tags", "entry.*")


def with_entry_index(entries: DataFrame, total: int) -> DataFrame:
    """1-based ordinal of each entry in its feed.

    Entries are numbered within their split of the file; only the counts of splits are summed in order, so no task
    ever sorts a whole feed. Hand in narrow columns: they are shuffled.
    """
    inside = Window.partitionBy(SPLIT).orderBy("piece", "sub")
    numbered = entries.withColumn("_place", F.row_number().over(inside))
    before = Window.partitionBy("feed_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = entries.groupBy(SPLIT).agg(F.count("*").alias("_rows")).select(
        *SPLIT, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    placed = keyed_join(numbered, starts, SPLIT, "left", total)
    return placed.withColumn("entry_index", F.col("_before") + F.col("_place")).drop("_before", "_place", "piece", "sub")
