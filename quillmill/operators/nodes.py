"""HTML structure as data: a `nodes` array per document, and extractors over it.

A document's nodes are in document order, so the descendants of node i are the slice
(i, end_ord]: every extractor is a narrow projection within the row. No join or shuffle is
needed, whatever the size of the corpus, and nothing is emitted in pairs.
"""

from __future__ import annotations

from typing import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType

from quillmill.functions.markup import MARKS, UNESCAPED_TAGS, VOID_TAGS, read_nodes
from quillmill.functions.text import in_portions, once, strip

# Fixed values of the blog editor's markup and of the Markdown dialect.
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
LIFTED_TAGS = ["table", "ul", "ol", "p", "blockquote", "pre"]
CAPTION_TABLE_CLASS = "tr-caption-container"
CAPTION_CELL_CLASS = "tr-caption"
SEPARATOR_CLASS = "separator"
WIDGET_TAGS = ["source-footnote", "sources-carousel-inline", "response-element", "model-response"]
PRESERVED_TAGS = ["iframe", "video", "audio", "object", "embed", "details", "svg", "canvas"]
CELL_BREAKERS = ["table", "ul", "ol", "pre", "blockquote"]
LANGUAGES = (
    "python py javascript js html css sql bash sh json xml java cpp c csharp ts typescript yaml ruby go rust php"
).split()

NODE = StructType([
    StructField("ord", IntegerType()),
    StructField("end_ord", IntegerType()),
    StructField("parent", IntegerType()),
    StructField("depth", IntegerType()),
    StructField("kind", StringType()),
    StructField("tag", StringType()),
    StructField("attrs", MapType(StringType(), StringType())),
    StructField("text", StringType()),
])
PARSED = StructType([StructField("nodes", ArrayType(NODE)), StructField("error", StringType())])
TEXT_KINDS = ["text", "cdata"]


@F.arrow_udf(PARSED)
def parsed_html(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Nodes of each document, or why it could not be read."""
    return in_portions(batches, _parsed_portion)


def _parsed_portion(documents: list[str | None]) -> pa.Array:
    columns: dict[str, list] = {field.name: [] for field in NODE}
    names, values, attr_offsets, doc_offsets, errors = [], [], [0], [0], []
    for html in documents:
        rows, error = {}, None
        try:
            rows = read_nodes(html or "")
        except Exception as failure:
            error = f"Failed to cleanly convert HTML content: {failure}"
        errors.append(error)
        number = len(rows.get("kind", ()))
        columns["ord"].extend(range(number))
        for name in rows:
            columns[name].extend(rows[name])
        for attrs in rows.get("attrs", ()):
            names.extend(attrs)
            values.extend(attrs.values())
            attr_offsets.append(len(names))
        doc_offsets.append(len(columns["ord"]))
    arrays = {name: pa.array(columns[name], pa.int32()) for name in ("ord", "end_ord", "parent", "depth")}
    arrays |= {name: pa.array(columns[name], pa.string()) for name in ("kind", "tag", "text")}
    arrays["attrs"] = pa.MapArray.from_arrays(
        pa.array(attr_offsets, pa.int32()), pa.array(names, pa.string()), pa.array(values, pa.string()))
    nodes = pa.StructArray.from_arrays([arrays[f.name] for f in NODE], [f.name for f in NODE])
    nodes = pa.ListArray.from_arrays(pa.array(doc_offsets, pa.int32()), nodes)
    return pa.StructArray.from_arrays([nodes, pa.array(errors, pa.string())], ["nodes", "error"])


def with_nodes(df: DataFrame, html: str = "html") -> DataFrame:
    """Add `nodes`, the array of all nodes of the document; empty if it could not be read."""
    return df.withColumn("_parsed", parsed_html(F.col(html))).withColumn("nodes", F.col("_parsed.nodes")).drop("_parsed")


def html_nodes(df: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """One row per node."""
    return with_nodes(df, html).select(*keys, F.inline("nodes"))


# --- expressions over the nodes of one document ------------------------------------------


def inside(doc: Column, node: Column) -> Column:
    """Descendants of `node`."""
    return F.slice(doc, node["ord"] + 2, node["end_ord"] - node["ord"])


def one_of(value: Column, words: Iterable[str]) -> Column:
    """Is the value among fixed words (without quotes)?"""
    return F.array_contains(F.expr("array(" + ", ".join(f"'{word}'" for word in words) + ")"), value)


def is_tag(*tags: str) -> Callable[[Column], Column]:
    """Only elements have tags."""
    return lambda n: n["tag"] == tags[0] if len(tags) == 1 else one_of(n["tag"], tags)


def tagged(nodes: Column, *tags: str) -> Column:
    return F.filter(nodes, is_tag(*tags))


def elements(nodes: Column) -> Column:
    return F.filter(nodes, lambda n: n["kind"] == "element")


def first(nodes: Column) -> Column:
    return F.try_element_at(nodes, F.lit(1))


def attr(node: Column, name: str) -> Column:
    return F.coalesce(node["attrs"][name], F.lit(""))


def text_of(doc: Column, node: Column, *, packed: bool = False) -> Column:
    """All text within; `packed` strips every piece first."""
    pieces = F.transform(F.filter(inside(doc, node), lambda n: n["kind"].isin(TEXT_KINDS)), lambda n: n["text"])
    return F.array_join(F.transform(pieces, strip) if packed else pieces, "")


def plain_array(nodes: Column) -> Column:
    """The nodes copied once, so that every later slice costs only its own length."""
    return F.filter(nodes, lambda n: n["ord"] >= 0)


def opening(node: Column) -> Column:
    """Place of the node's start among the starts and ends of all nodes; every node has both."""
    return 2 * node["ord"] - node["depth"] + 1


def closing(node: Column) -> Column:
    return 2 * (node["end_ord"] + 1) - node["depth"]


def events(doc: Column) -> Column:
    """Starts and ends of all nodes in order: `place, ord, close`."""
    both = F.transform(doc, lambda n: F.array(
        F.struct(opening(n).alias("place"), n["ord"].alias("ord"), F.lit(False).alias("close")),
        F.struct(closing(n).alias("place"), n["ord"].alias("ord"), F.lit(True).alias("close"))))
    return F.array_sort(F.flatten(both))


def _escaped(text: Column) -> Column:
    for mark, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(mark), F.lit(reference))
    return text


def _quoted(value: Column) -> Column:
    plain, double = F.concat(F.lit('"'), value, F.lit('"')), F.replace(value, F.lit('"'), F.lit("&quot;"))
    single = F.concat(F.lit("'"), value, F.lit("'"))
    return F.when(~value.contains('"'), plain).when(~value.contains("'"), single).otherwise(F.concat(F.lit('"'), double, F.lit('"')))


def outer_html(doc: Column, line: Column, node: Column, *, code_classes: bool = False) -> Column:
    """The element as HTML text again; `line` are the `events` of the document.

    With `code_classes`, a `pre` that has a class shows those of its first `code` element, too.
    """
    def attribute(n: Column, pair: Column) -> Column:
        value = pair["value"]
        if code_classes:
            both = F.array_join(F.concat(classes(n), classes(first(tagged(inside(doc, n), "code")))), " ")
            value = F.when((n["tag"] == "pre") & (pair["key"] == "class"), both).otherwise(value)
        return F.concat(F.lit(" "), pair["key"], F.lit("="), _quoted(_escaped(value)))

    def start(n: Column) -> Column:
        head = F.concat(F.lit("<"), n["tag"], F.array_join(F.transform(F.map_entries(n["attrs"]), lambda pair: attribute(n, pair)), ""))
        return F.concat(head, F.when(_is_closed(n), "/>").otherwise(">"))

    def leaf(n: Column) -> Column:
        holder = F.get(doc, n["parent"])
        text = F.when(F.coalesce(one_of(holder["tag"], sorted(UNESCAPED_TAGS)), F.lit(False)), n["text"]).otherwise(_escaped(n["text"]))
        for kind, (before, after) in MARKS.items():
            text = F.when(n["kind"] == kind, F.concat(F.lit(before), n["text"], F.lit(after))).otherwise(text)
        return text

    def token(n: Column, close: Column) -> Column:
        ended = F.when(_is_closed(n) | (n["kind"] != "element"), "").otherwise(F.concat(F.lit("</"), n["tag"], F.lit(">")))
        return F.when(close, ended).otherwise(F.when(n["kind"] == "element", start(n)).otherwise(leaf(n)))

    span = F.slice(line, opening(node) + 1, closing(node) - opening(node) + 1)
    return F.array_join(F.transform(span, lambda e: token(F.get(doc, e["ord"]), e["close"])), "")


def _is_closed(node: Column) -> Column:
    """Written as a single tag."""
    return one_of(node["tag"], sorted(VOID_TAGS)) & (node["end_ord"] == node["ord"])


def classes(node: Column) -> Column:
    return F.filter(F.split(attr(node, "class"), r"\s+"), lambda c: c != "")


def extract(df: DataFrame, keys: list[str], of_document: Callable[[Column], Column]) -> DataFrame:
    """Rows of the struct array `of_document` makes from the nodes of each document."""
    return df.select(*keys, F.inline(once(plain_array(F.col("nodes")), of_document)))


def _fields(**columns: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in columns.items()])


# --- extractors --------------------------------------------------------------------------


def links(df: DataFrame, keys: list[str]) -> DataFrame:
    return extract(df, keys, lambda doc: F.transform(
        F.filter(tagged(doc, "a"), lambda n: attr(n, "href") != ""),
        lambda n: _fields(ord=n["ord"], href=attr(n, "href"), text=text_of(doc, n)),
    ))


def images(df: DataFrame, keys: list[str]) -> DataFrame:
    """Images with the target of the nearest link around them."""

    def with_links(doc: Column, links: Column) -> Column:
        # Only links with images inside can be around one; usually they hold one each.
        around = lambda image: F.filter(links, lambda a: (a["ord"] < image["ord"]) & (a["end_ord"] >= image["ord"]))
        return F.transform(tagged(doc, "img"), lambda n: _fields(
            ord=n["ord"], src=attr(n, "src"), alt=attr(n, "alt"), href=F.try_element_at(around(n), F.lit(-1))["href"]))

    def holders(doc: Column) -> Column:
        some = F.filter(tagged(doc, "a"), lambda a: F.exists(inside(doc, a), is_tag("img")))
        return F.transform(some, lambda a: _fields(ord=a["ord"], end_ord=a["end_ord"], href=a["attrs"]["href"]))

    return extract(df, keys, lambda doc: once(holders(doc), lambda links: with_links(doc, links)))


def headings(df: DataFrame, keys: list[str]) -> DataFrame:
    return extract(df, keys, lambda doc: F.transform(
        tagged(doc, *HEADINGS),
        lambda n: _fields(
            ord=n["ord"], level=F.substring(n["tag"], 2, 1).cast("int"),
            text=F.regexp_replace(strip(text_of(doc, n)), r"[\t \r\n]+", " "),
        ),
    ))


def captions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Caption tables: image, target of the first link, caption."""

    def fields(doc: Column, table: Column) -> Column:
        within = inside(doc, table)
        image = first(tagged(within, "img"))
        cell = first(F.filter(tagged(within, "td"), lambda c: attr(c, "class").contains(CAPTION_CELL_CLASS)))
        caption = F.coalesce(text_of(doc, cell, packed=True), F.lit(""))
        href = attr(first(tagged(within, "a")), "href")
        return F.when(image.isNotNull(), _fields(
            ord=table["ord"], src=attr(image, "src"), href=F.when(href != "", href),
            alt=F.coalesce(image["attrs"]["alt"], caption), caption=caption,
        ))

    return extract(df, keys, lambda doc: F.filter(
        F.transform(
            F.filter(tagged(doc, "table"), lambda t: attr(t, "class").contains(CAPTION_TABLE_CLASS)),
            lambda t: fields(doc, t),
        ),
        lambda c: c.isNotNull(),
    ))


def _merges(span: Column) -> Column:
    number = strip(span)
    whole = F.regexp_extract(number, r"\A[+-]?0*(\d+)\z", 1)
    more = (F.length(whole) > 1) | (whole > "1")
    return (span != "") & ((whole == "") | (more & ~number.startswith("-")))


def is_complex_table(doc: Column, table: Column) -> Column:
    """Merged cells, or cells with blocks that a pipe table cannot hold."""
    return F.exists(
        tagged(inside(doc, table), "td", "th"),
        lambda c: _merges(attr(c, "colspan")) | _merges(attr(c, "rowspan"))
        | F.exists(inside(doc, c), is_tag(*CELL_BREAKERS)),
    )


def complex_tables(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every table, and whether it must stay HTML."""
    return extract(df, keys, lambda doc: F.transform(
        tagged(doc, "table"),
        lambda t: _fields(
            ord=t["ord"], cells=F.size(tagged(inside(doc, t), "td", "th")), is_complex=is_complex_table(doc, t)),
    ))


def pipe_tables(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the tables that Markdown can hold, as cell texts between bars."""

    def line(doc: Column, row: Column) -> Column:
        texts = F.transform(
            tagged(inside(doc, row), "td", "th"),
            lambda c: F.replace(strip(text_of(doc, c)), F.lit("\n"), F.lit(" ")),
        )
        return F.concat(F.lit("| "), F.array_join(texts, " | "), F.lit(" |"))

    return extract(df, keys, lambda doc: F.flatten(F.transform(
        F.filter(tagged(doc, "table"), lambda t: ~is_complex_table(doc, t)),
        lambda t: F.transform(
            tagged(inside(doc, t), "tr"),
            lambda row, at: _fields(table_ord=t["ord"], row=at, line=line(doc, row)),
        ),
    )))


def code_language(doc: Column, pre: Column) -> Column:
    """The language that the classes of a preformatted block and of the code in it name."""

    def named(names: Column) -> Column:
        brush = F.lower(F.regexp_extract(F.array_join(names, " "), r"(?iU)brush:\s*(\w+)", 1))
        hints = F.filter(
            F.transform(names, F.lower),
            lambda c: c.startswith("lang-") | c.startswith("language-") | one_of(c, LANGUAGES),
        )
        hint = F.coalesce(first(hints), F.lit(""))
        return F.when(brush != "", brush).otherwise(F.regexp_replace(hint, r"\A(?:lang|language)-", ""))

    return once(F.concat(classes(pre), classes(first(tagged(inside(doc, pre), "code")))), named)


def code_text(doc: Column, pre: Column) -> Column:
    return F.regexp_replace(text_of(doc, pre), r"\A[\r\n]+|[\r\n]+\z", "")


def code_blocks(df: DataFrame, keys: list[str]) -> DataFrame:
    """Preformatted blocks with the language their classes name."""
    return extract(df, keys, lambda doc: F.transform(
        tagged(doc, "pre"), lambda n: _fields(ord=n["ord"], language=code_language(doc, n), code=code_text(doc, n))))


def lifted_blocks(df: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks inside headings, with the place each takes behind its heading (last one first)."""

    def moves(doc: Column, heading: Column) -> Column:
        blocks = tagged(inside(doc, heading), *LIFTED_TAGS)
        return F.transform(blocks, lambda b, at: _fields(
            heading_ord=heading["ord"], ord=b["ord"], tag=b["tag"], place=F.size(blocks) - at))

    return extract(df, keys, lambda doc: F.flatten(
        F.transform(tagged(doc, *HEADINGS), lambda h: moves(doc, h))))


def is_blank(doc: Column, node: Column) -> Column:
    return text_of(doc, node, packed=True) == ""


def is_spacer(doc: Column, box: Column) -> Column:
    within = F.filter(inside(doc, box), lambda k: k["kind"] != "comment")
    lone_break = (F.size(within) == 1) & F.coalesce(first(within)["tag"] == "br", F.lit(False))
    return ((F.size(elements(within)) == 0) & is_blank(doc, box)) | lone_break


def spacers(df: DataFrame, keys: list[str]) -> DataFrame:
    """Boxes with nothing in them but blanks, or with a single line break."""
    return extract(df, keys, lambda doc: F.transform(
        F.filter(tagged(doc, "div", "p"), lambda n: is_spacer(doc, n)),
        lambda n: _fields(ord=n["ord"], tag=n["tag"]),
    ))


def is_separator(doc: Column, box: Column) -> Column:
    within = elements(inside(doc, box))
    return attr(box, "class").contains(SEPARATOR_CLASS) & F.exists(within, is_tag("img")) & (F.size(within) <= 2)


def separators(df: DataFrame, keys: list[str]) -> DataFrame:
    """Image wrappers to unwrap: an image inside and no more than two elements."""
    return extract(df, keys, lambda doc: F.transform(
        F.filter(tagged(doc, "div"), lambda n: is_separator(doc, n)), lambda n: _fields(ord=n["ord"])))


def is_empty_widget(doc: Column, node: Column) -> Column:
    return is_blank(doc, node) & ~F.exists(inside(doc, node), is_tag("img"))


def widgets(df: DataFrame, keys: list[str]) -> DataFrame:
    """Pasted widget tags, and whether each is dropped (empty) or unwrapped."""
    action = lambda doc, node: F.when(is_empty_widget(doc, node), "drop").otherwise("unwrap")
    return extract(df, keys, lambda doc: F.transform(
        tagged(doc, *WIDGET_TAGS), lambda n: _fields(ord=n["ord"], tag=n["tag"], action=action(doc, n))))


def list_items(df: DataFrame, keys: list[str]) -> DataFrame:
    """List items with the bullet Markdown gives them: a dash, or the rank in an ordered list."""

    def item(doc: Column, node: Column, rank: Column) -> Column:
        holder = F.get(doc, node["parent"])
        start = F.coalesce(F.regexp_extract(attr(holder, "start"), r"\A\d{1,9}\z", 0).try_cast("int"), F.lit(1))
        number = F.concat((start + rank).cast("string"), F.lit("."))
        return _fields(
            ord=node["ord"], bullet=F.when(F.coalesce(holder["tag"] == "ol", F.lit(False)), number).otherwise("-"),
            text=strip(text_of(doc, node)))

    def ranked(doc: Column, found: Column) -> Column:
        # Sorted by their lists; an item's rank is its distance from the first of its list.
        return once(found["parent"], lambda lists: F.transform(found, lambda li, at: item(
            doc, F.get(doc, li["ord"]), at - F.array_position(lists, li["parent"]).cast("int") + 1)))

    def items(doc: Column) -> Column:
        found = F.transform(tagged(doc, "li"), lambda n: F.struct(n["parent"].alias("parent"), n["ord"].alias("ord")))
        return once(F.array_sort(found), lambda sorted_items: ranked(doc, sorted_items))

    return extract(df, keys, items).select(*keys, "ord", "bullet", "text")


def embeds(df: DataFrame, keys: list[str]) -> DataFrame:
    """Elements that stay HTML, as HTML."""
    return extract(df, keys, lambda doc: once(events(doc), lambda line: F.transform(
        tagged(doc, *PRESERVED_TAGS), lambda n, at: _fields(at=at, tag=n["tag"], outer_html=outer_html(doc, line, n)))))
