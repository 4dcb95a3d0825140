"""WARC archives: one gzip member for each record, written by Spark, and a splittable reader.

Writing uses Spark's text sink, so files are committed like any other output: a record's
member goes in as a line less its last byte, which is always 0, and 0 is the line separator.

Reading uses Spark's text source with the gzip magic as separator. Each task scans a byte
range for it and owns what starts inside the range. The magic can also occur within compressed
data, so candidates are validated: a member must decode, and begin like a WARC record.
Pieces that do not are joined to the member before them, across ranges where it must be.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.llm.common import salted_join
from quillmill.session import ship
from quillmill.staging import stage, staging_path

MAGIC = b"\x1f\x8b\x08"
MIN_REVISIT_BYTES = 1000
_DATE = "2000-01-01T00:00:00Z"
_URN = "urn:page:"
_LEVEL = 2


def gzip_member(data: bytes) -> bytes:
    """A gzip member whose last byte is 0 (an empty member follows where its own is not)."""
    def one(data: bytes) -> bytes:
        packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
        return packer.compress(data) + packer.flush()
    member = one(data)
    return member if member[-1] == 0 else member + one(b"")


def warc_record(page_id, url: str | None, payload: bytes, kind: str, size: int, digest: str, refers_to) -> bytes:
    """One record with an HTTP response as its block; a revisit has the response's head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    uri = (url or "").encode("unicode_escape").decode("ascii")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_URN}{_text(page_id)}>", f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {uri}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_URN}{_text(refers_to)}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _text(page_id) -> str:
    return "" if page_id is None else str(page_id)


def revisits(pages: DataFrame, least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """`pages` (page_id, url, payload) with `bytes, digest, refers_to`; refers_to is null for responses.

    Of equal payloads of `least` bytes or more the largest page_id is the response (all rows of it, if
    it repeats) and the others refer to it. Where no row of a group has a page_id, all are responses.
    """
    told = pages.withColumns({"digest": F.sha1("payload"), "same": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")})
    groups = told.where(F.col("bytes") >= least).groupBy("same").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("copies"))
    groups = stage(groups.where("copies > 1 AND newest IS NOT NULL").select("same", "newest"), "copies")
    met = salted_join(told, groups, ["same"], F.col("page_id"))
    return met.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("newest")), F.col("newest"))).drop("same", "newest")


def write_warc(pages: DataFrame, path: str, least: int = MIN_REVISIT_BYTES) -> None:
    """Write a record for every row of `pages` (page_id, url, html; null html: empty) below `path`."""
    ship(pages.sparkSession)
    told = revisits(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")), least)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name) for name in ("page_id", "url", "bytes", "digest", "refers_to")]
            payloads = batch.column("payload").cast(pa.binary())
            for start in range(0, batch.num_rows, 64):
                members = []
                for i in range(start, min(start + 64, batch.num_rows)):
                    page_id, url, size, digest, refers_to = (column[i].as_py() for column in columns)
                    kind = "response" if refers_to is None else "revisit"
                    record = warc_record(page_id, url, payloads[i].as_py() if refers_to is None else b"", kind, size, digest, refers_to)
                    members.append(gzip_member(record)[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])

    sent = told.select("page_id", "url", "bytes", "digest", "refers_to", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"))
    members = sent.mapInArrow(write, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def _decoded(member: bytes) -> tuple[bytes | None, bool, bool]:
    """Content of a whole member, else None; whether it may go on; whether it begins like a record."""
    reader = zlib.decompressobj(31)
    try:
        content = reader.decompress(member)
    except zlib.error:
        return None, False, False
    if reader.eof:
        whole = not reader.unused_data.strip(b"\0")
        return (content if whole else None), False, whole
    return None, content[:5] == b"WARC/"[: len(content)], content[:5] == b"WARC/"


def _pieces(wanted: tuple[str, ...]):
    """Contents of whole members of each byte range, or the pieces (`part`) that make none in there."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept in _sorted_pieces(batches):
            kept = [row for row in kept if row[3] in wanted]
            if kept:
                yield _rows(kept)
    return pieces


def _sorted_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    held, held_at, place, number = b"", 0, None, 0
    out: list[tuple] = []

    def let_go() -> None:
        nonlocal held
        if held:
            out.append((*place, held_at, "part", held))
            held = b""

    for batch in batches:
        columns = [batch.column(name) for name in ("path", "start", "piece")]
        for i in range(batch.num_rows):
            path, start, piece = (column[i].as_py() for column in columns)
            if (path, start) != place:
                if path.endswith(".gz"):
                    raise ValueError(f"{path}: Spark has unpacked it, as it does with files named so; call it .warc")
                let_go()
                place, number = (path, start), 0
            number += 1
            piece = MAGIC + piece
            if held:
                content, _, begins = _decoded(held + piece)
                if content is not None:
                    out.append((*place, number, "whole", content))
                    held = b""
                    continue
                if begins:
                    held += piece
                    continue
                let_go()
            content, _, begins = _decoded(piece)
            if content:
                out.append((*place, number, "whole", content))
            elif begins and content is None:
                held, held_at = piece, number
            elif content is None:
                out.append((*place, number, "part", piece))
            if len(out) >= 64:
                yield out
                out = []
    let_go()
    yield out


_PIECES = ["path", "start", "number", "kind", "data"]


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], _PIECES)


def _joined(table: pa.Table) -> pa.Table:
    """Members that a range's end cuts, of the pieces left over in one file: few, in order."""
    parts = table.sort_by([("start", "ascending"), ("number", "ascending")]).column("data").to_pylist()
    found, i = [], 0
    while i < len(parts):
        member, step = b"", 1
        for j in range(i, len(parts)):
            member += parts[j]
            content, more, _ = _decoded(member)
            if content is not None:
                found, step = [*found, content], j + 1 - i
            if content is not None or not more:
                break
        i += step
    return pa.table([pa.array([one for one in found if one], pa.binary())], ["record"])


def parse_record(record: bytes) -> dict:
    """Headers (names in lower case) and block of a WARC record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    return {"headers": headers, "block": rest[: int(headers["content-length"])]}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """`record` (binary) for each WARC record in the gzip files below `path`, whatever the splits.

    Members that never decode are left out, as a truncated file's last one is. Files must not be
    named `.gz`: Spark's text source would unpack each of those in a single task.
    """
    ship(spark)
    ranges = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    ranges = ranges.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece"))
    ranges = ranges.where(F.octet_length("piece") > 0)
    kind = "path string, start long, number long, kind string, data binary"
    whole = ranges.mapInArrow(_pieces(("whole",)), kind).select(F.col("data").alias("record"))
    cut = ranges.mapInArrow(_pieces(("part",)), kind)  # few: members that a range's end cuts at a false magic
    return whole.unionByName(cut.groupBy("path").applyInArrow(_joined, "record binary"))


def page_records(records: DataFrame) -> DataFrame:
    """`page_id, payload_bytes, payload_digest, record_type, refers_to` read from records `write_warc` wrote.

    A response's size and digest come from its payload, a revisit's from its headers.
    """
    ship(records.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for one in batch.column("record"):
                record = parse_record(one.as_py())
                headers = record["headers"]
                http, _, payload = record["block"].partition(b"\r\n\r\n")
                revisit = headers["warc-type"] == "revisit"
                size = int(http.rpartition(b"Content-Length:")[2]) if revisit else len(payload)
                digest = headers["warc-payload-digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest()
                rows.append((_page(headers["warc-record-id"]), size, digest, headers["warc-type"], _page(headers["warc-refers-to"]) if revisit else None))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                                             ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return records.select("record").mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _page(urn: str) -> int | None:
    number = urn.strip("<>").removeprefix(_URN)
    return int(number) if number else None


def archive_path(spark: SparkSession) -> str:
    return staging_path(spark, "warc")
