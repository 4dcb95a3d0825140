"""Text rules of the archive format as built-in column expressions.

Whitespace means Unicode whitespace plus the separators U+001C..U+001F, which is what the
archive rules strip; Spark's ``trim`` would strip spaces only.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from quillmill.functions.entities import decode_outside_fences

SPACE = r"\s\x1C-\x1F"
# Bytes of text that a Python worker turns into objects at once, unless a single text is larger.
PORTION_BYTES = 2**20


def in_portions(batches: Iterator[pa.Array], made: Callable[[list[str | None]], pa.Array]) -> Iterator[pa.Array]:
    """`made` of a few consecutive texts at a time, so that a worker's memory does not grow with its batches."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch), 0).to_pylist()
        first, held = 0, 0
        for at, size in enumerate(sizes):
            if at > first and held + size > PORTION_BYTES:
                yield made(batch.slice(first, at - first).to_pylist())
                first, held = at, 0
            held += size
        yield made(batch.slice(first).to_pylist())


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)\A[{SPACE}]+|[{SPACE}]+\z", "")


def once(c: Column, use: Callable[[Column], Column]) -> Column:
    """`use(c)` with `c` computed a single time, however often `use` mentions it.

    A fold over nothing hands its start to the last step as it is; `transform` would copy it, whatever its size.
    """
    return F.aggregate(F.expr("cast(array() AS array<int>)"), c, lambda value, _: value, use)


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def capitalized(c: Column) -> Column:
    """First letter upper, all others lower (``initcap`` would raise every word)."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 2**31 - 1)))


def json_scalar(c: Column) -> Column:
    """A string or number as JSON text, ``null`` included."""
    wrapped = F.to_json(F.array(c))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def escape_bars(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


@lru_cache(maxsize=None)
def _digit_class() -> str:
    """Decimal digits plus the other signs Unicode counts as digits (such as superscripts)."""
    others = (
        f"\\x{{{point:X}}}"
        for point in range(0x110000)
        if chr(point).isdigit() and unicodedata.category(chr(point)) != "Nd"
    )
    return r"\p{Nd}" + "".join(others)


def date_prefix(c: Column) -> Column:
    """``YYYY-MM-DD`` head of an ISO stamp, or ``undated``; month and day are not validated."""
    stamp = strip(c)
    dated = stamp.rlike(rf"(?s)\A[{_digit_class()}]{{4}}-.{{2}}-.{{2}}")
    return F.when(dated, F.left(stamp, F.lit(10))).otherwise("undated")


@F.arrow_udf(StringType())
def _decompose(titles: pa.Array) -> pa.Array:
    return pc.utf8_normalize(titles, form="NFKD")


def slug(c: Column, max_length: int = 60) -> Column:
    """File-name-safe form of a title: ASCII letters, digits, ``_`` and single dashes.

    Decomposition changes other characters only, so plain titles stay in the JVM.
    """
    decomposed = F.coalesce(_decompose(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)
    ascii_only = F.regexp_replace(decomposed, r"[^\x00-\x7F]", "")
    words = F.lower(strip(F.regexp_replace(ascii_only, rf"[^\w{SPACE}-]", "")))
    dashed = F.regexp_replace(words, rf"[-{SPACE}]+", "-")

    def cut(whole: Column) -> Column:
        return F.when(whole == "", "post").otherwise(F.regexp_replace(F.left(whole, F.lit(max_length)), r"-+\z", ""))

    return once(dashed, cut)


def tidy_lines(c: Column) -> Column:
    """Unix newlines, at most one blank line in a row, no trailing blanks, outer strip."""
    unix = F.regexp_replace(c, r"\r\n?", "\n")
    blanked = F.regexp_replace(unix, r"(?md)^[ \t]+$", "")
    collapsed = F.regexp_replace(blanked, r"\n{3,}", "\n\n")
    trimmed = F.regexp_replace(collapsed, rf"(?U)[{SPACE}&&[^\n]]+(?=\n|\z)", "")
    return strip(trimmed)


@F.arrow_udf(StringType())
def _decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return in_portions(
        batches, lambda texts: pa.array([None if t is None else decode_outside_fences(t) for t in texts], pa.string()))


def decode_references(c: Column) -> Column:
    """Character references and no-break spaces resolved outside code fences; texts without any stay in the JVM.

    Hand in a column, not a long expression: it is looked at several times.
    """
    return F.coalesce(_decode(F.when(c.contains("&") | c.contains("\u00a0"), c)), c)


def postprocess_markdown(c: Column) -> Column:
    """References resolved outside code fences, then lines tidied."""
    return tidy_lines(decode_references(c))
