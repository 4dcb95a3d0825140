"""Repairs of the blog editor's markup, as edits of a document's node array.

A document is the ordered sequence of the starts and ends of its nodes. An edit gives them other places, leaves
some out or puts new ones in; from the new sequence follow the numbers, depths and parents of the nodes that are
left. Every step is an expression within the row, and documents without the tags in question skip it.
"""

from __future__ import annotations

from functools import cache
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions.markup import ASCII_SPACE, KEEP_SPACE_TAGS
from quillmill.functions.text import once
from quillmill.operators.nodes import (
    CAPTION_CELL_CLASS, CAPTION_TABLE_CLASS, HEADINGS, LIFTED_TAGS, WIDGET_TAGS, attr, events, first, inside, is_empty_widget,
    is_separator, is_spacer, is_tag, plain_array, tagged, text_of, with_nodes,
)

NODE_TYPE = "struct<ord: int, end_ord: int, parent: int, depth: int, kind: string, tag: string, attrs: map<string, string>, text: string>"


def holds(outer: Column, inner: Column) -> Column:
    """Is `inner` the node `outer` or within it?"""
    return (outer["ord"] <= inner["ord"]) & (inner["ord"] <= outer["end_ord"])


def outermost(nodes: Column) -> Column:
    """Of some nodes of a document, in order, those that are not within another of them."""
    none = F.filter(nodes, lambda n: F.lit(False))

    def step(state: Column, n: Column) -> Column:
        return F.when(n["ord"] <= state["end"], state).otherwise(F.struct(
            n["end_ord"].alias("end"), F.array_append(state["kept"], n).alias("kept")))

    return F.aggregate(nodes, F.struct(F.lit(-1).alias("end"), none.alias("kept")), step, lambda state: state["kept"])


def regions(nodes: Column) -> Column:
    """What some nodes span, in order, those within others left out."""
    return outermost(F.array_sort(F.transform(nodes, lambda n: F.struct(n["ord"].alias("ord"), n["end_ord"].alias("end_ord")))))


def single(ords: Column) -> Column:
    return F.transform(ords, lambda o: F.struct(o.alias("ord"), o.alias("end_ord")))


def covered(doc: Column, spans: Column) -> Column:
    """For each node: is it in one of the spans, which are in order and apart from each other?

    Put in one order with the nodes, as many spans begin up to a node as its place is behind its number.
    """
    def flags(spans: Column) -> Column:
        both = F.array_sort(F.concat(
            F.transform(spans, lambda s: F.struct(s["ord"].alias("ord"), F.lit(0).alias("node"))),
            F.transform(doc, lambda n: F.struct(n["ord"].alias("ord"), F.lit(1).alias("node")))))
        placed = F.filter(F.transform(both, lambda b, at: F.struct(b["node"].alias("node"), at.alias("at"))), lambda b: b["node"] == 1)
        return F.transform(placed, lambda b, ord: F.coalesce(F.get(spans, b["at"] - ord - 1)["end_ord"] >= ord, F.lit(False)))

    return once(spans, flags)


def renumbered(doc: Column, line: Column) -> Column:
    """The nodes whose starts and ends are left in `line` (`ord, close`), in its order, with all numbers new.

    The start of a node comes after as many starts as its new number and as many ends as the rest of its place, so
    its depth follows; likewise the number of its last node from its end. Put in order of depth, the nodes of one
    depth stand between the children of the nodes before, so a child's parent is the node that precedes it.
    """
    def paired(placed: Column) -> Column:
        starts = F.transform(F.filter(placed, lambda e: ~e["close"]), lambda e, j: F.struct(
            e["ord"].alias("old"), j.alias("ord"), (2 * j - e["at"] + 1).alias("depth")))
        ends = F.transform(F.filter(placed, lambda e: e["close"]), lambda e, j: F.struct(
            e["ord"].alias("old"), (e["at"] - j - 1).alias("end_ord")))
        return F.array_sort(F.zip_with(F.array_sort(starts), F.array_sort(ends), lambda a, b: F.struct(
            a["ord"].alias("ord"), b["end_ord"].alias("end_ord"), a["depth"].alias("depth"), a["old"].alias("old"))))

    def parents(nodes: Column) -> Column:
        by_depth = F.array_sort(F.concat(
            F.transform(nodes, lambda n: F.struct(n["depth"].alias("depth"), n["ord"].alias("ord"), F.lit(False).alias("child"))),
            F.transform(nodes, lambda n: F.struct((n["depth"] - 1).alias("depth"), n["ord"].alias("ord"), F.lit(True).alias("child")))))
        numbered = F.transform(by_depth, lambda n, at: F.struct(n["ord"].alias("ord"), n["child"].alias("child"), at.alias("at")))

        def found(all_nodes: Column, before: Column) -> Column:
            kids = F.transform(F.filter(all_nodes, lambda n: n["child"]), lambda n, rank: F.struct(
                n["ord"].alias("ord"), F.coalesce(F.get(before, n["at"] - rank - 1)["ord"], F.lit(-1)).alias("parent")))
            return F.array_sort(kids)

        return once(numbered, lambda all_nodes: once(
            F.filter(all_nodes, lambda n: ~n["child"]), lambda before: found(all_nodes, before)))

    def joined(nodes: Column) -> Column:
        return F.zip_with(nodes, parents(nodes), lambda n, p: once(F.get(doc, n["old"]), lambda old: F.struct(
            n["ord"].alias("ord"), n["end_ord"].alias("end_ord"), p["parent"].alias("parent"), n["depth"].alias("depth"),
            old["kind"].alias("kind"), old["tag"].alias("tag"), old["attrs"].alias("attrs"), old["text"].alias("text"))))

    placed = F.transform(line, lambda e, at: F.struct(e["ord"].alias("ord"), e["close"].alias("close"), at.alias("at")))
    return once(once(placed, paired), joined).cast(f"array<{NODE_TYPE}>")


def _edited(doc: Column, needed: Column, edit: Callable[[Column], Column]) -> Column:
    return F.when(needed, edit(doc)).otherwise(doc)


def lift_blocks(doc: Column) -> Column:
    """Comments go. Blocks at any depth inside a heading move right behind it, the last one first.

    A block within another one moves on its own. Of headings within each other the outermost counts.
    """
    def moved(doc: Column, blocks: Column) -> Column:
        def place(event: Column) -> Column:
            node = F.get(doc, event["ord"])
            block = F.try_element_at(F.filter(blocks, lambda b: holds(b, node)), F.lit(-1))
            return once(block, lambda block: F.struct(
                F.coalesce(block["behind"], event["place"]).alias("major"),
                # Behind the heading's end, of which the place is the same, the last block comes first.
                F.coalesce(-block["ord"], F.lit(-2**31 + 1)).alias("minor"),
                event["place"].alias("place"), event["ord"].alias("ord"), event["close"].alias("close")))

        left = F.filter(events(doc), lambda e: F.get(doc, e["ord"])["kind"] != "comment")
        return renumbered(doc, F.array_sort(F.transform(left, place)))

    def blocks_of(heading: Column) -> Column:
        end = 2 * (heading["end_ord"] + 1) - heading["depth"]
        return lambda doc: F.transform(tagged(inside(doc, heading), *LIFTED_TAGS), lambda b: F.struct(
            b["ord"].alias("ord"), b["end_ord"].alias("end_ord"), end.alias("behind")))

    def edit(doc: Column) -> Column:
        blocks = F.flatten(F.transform(outermost(tagged(doc, *HEADINGS)), lambda h: blocks_of(h)(doc)))
        return once(blocks, lambda found: moved(doc, found))

    nested = F.exists(tagged(doc, *HEADINGS), lambda h: F.exists(inside(doc, h), is_tag(*LIFTED_TAGS)))
    return _edited(doc, F.exists(doc, lambda n: n["kind"] == "comment") | nested, edit)


def _element(tag: str, **attrs: Column) -> Column:
    pairs = [part for name, value in attrs.items() for part in (F.lit(name), value)]
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return _new(F.lit("element"), F.lit(tag), F.create_map(*pairs) if pairs else empty, F.lit(""))


def _new(kind: Column, tag: Column, attrs: Column, text: Column) -> Column:
    nothing = F.lit(0)
    return F.struct(
        nothing.alias("ord"), nothing.alias("end_ord"), nothing.alias("parent"), nothing.alias("depth"),
        kind.alias("kind"), tag.alias("tag"), attrs.alias("attrs"), text.alias("text")).cast(NODE_TYPE)


def unpack_captions(doc: Column) -> Column:
    """An image table becomes the image (linked if its first link leads anywhere) and a caption; blank boxes, and boxes
    with a single line break, go."""
    def parts(doc: Column, table: Column) -> Column:
        """The new nodes of a table, and their starts and ends, numbered from 0."""
        within = inside(doc, table)
        image, link = first(tagged(within, "img")), first(tagged(within, "a"))
        cell = first(F.filter(tagged(within, "td"), lambda c: attr(c, "class").contains(CAPTION_CELL_CLASS)))
        caption = F.coalesce(text_of(doc, cell, packed=True), F.lit(""))
        href = attr(link, "href")
        nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
        nodes = F.array(
            _element("div"), _element("a", href=href),
            _element("img", src=attr(image, "src"), alt=F.coalesce(image["attrs"]["alt"], caption)),
            _element("p"), _element("em"), _new(F.lit("text"), F.lit(""), nothing, caption))
        order = [(0, False), (1, False), (2, False), (2, True), (1, True), (3, False), (4, False), (5, False), (5, True), (4, True), (3, True), (0, True)]
        steps = F.array(*[F.struct(F.lit(n).alias("ord"), F.lit(close).alias("close")) for n, close in order])
        steps = F.filter(steps, lambda e: ((href != "") | (e["ord"] != 1)) & ((caption != "") | (e["ord"] < 3)))
        return F.struct(nodes.alias("nodes"), steps.alias("steps"), (2 * table["ord"] - table["depth"] + 1).alias("place"))

    def edit(doc: Column, tables: Column, dropped: Column) -> Column:
        made = F.transform(tables, lambda t: parts(doc, t))

        def replaced(made: Column) -> Column:
            gone = covered(doc, regions(F.concat(tables, dropped)))
            left = once(gone, lambda gone: F.filter(events(doc), lambda e: ~F.get(gone, e["ord"])))
            kept = F.transform(left, lambda e: F.struct(
                e["place"].alias("place"), F.lit(0).alias("step"), e["ord"].alias("ord"), e["close"].alias("close")))
            new = F.flatten(F.transform(made, lambda m, number: F.transform(m["steps"], lambda e, step: F.struct(
                m["place"].alias("place"), step.alias("step"), (F.size(doc) + number * 6 + e["ord"]).alias("ord"), e["close"].alias("close")))))
            every = F.concat(doc, F.flatten(F.transform(made, lambda m: m["nodes"])))
            return once(every, lambda every: renumbered(every, F.array_sort(F.concat(kept, new))))

        return once(made, replaced)

    tables = outermost(F.filter(tagged(doc, "table"), lambda t: attr(t, "class").contains(CAPTION_TABLE_CLASS) & F.exists(
        inside(doc, t), is_tag("img"))))
    dropped = F.filter(tagged(doc, "div", "p"), lambda n: is_spacer(doc, n))
    return once(F.struct(tables.alias("tables"), dropped.alias("dropped")), lambda found: _edited(
        doc, (F.size(found["tables"]) > 0) | (F.size(found["dropped"]) > 0), lambda doc: edit(doc, found["tables"], found["dropped"])))


def unwrap_boxes(doc: Column) -> Column:
    """Image wrappers and pasted widget tags give way to what is in them; widgets without any go."""
    def edit(doc: Column, dropped: Column, unwrapped: Column) -> Column:
        marks = F.struct(covered(doc, regions(dropped)).alias("gone"), covered(doc, single(F.array_sort(unwrapped))).alias("open"))
        return renumbered(doc, once(marks, lambda m: F.filter(
            events(doc), lambda e: ~F.get(m["gone"], e["ord"]) & ~F.get(m["open"], e["ord"]))))

    widgets = tagged(doc, *WIDGET_TAGS)
    dropped = F.filter(widgets, lambda n: is_empty_widget(doc, n))
    unwrapped = F.concat(F.filter(widgets, lambda n: ~is_empty_widget(doc, n)), F.filter(tagged(doc, "div"), lambda n: is_separator(doc, n)))
    return once(F.struct(dropped.alias("dropped"), unwrapped["ord"].alias("unwrapped")), lambda found: _edited(
        doc, (F.size(found["dropped"]) > 0) | (F.size(found["unwrapped"]) > 0),
        lambda doc: edit(doc, found["dropped"], found["unwrapped"])))


def join_texts(doc: Column) -> Column:
    """Neighbouring texts become one, as they would when the repaired page is read again."""
    def goes_on(doc: Column, n: Column) -> Column:
        before = F.get(doc, n["ord"] - 1)
        return F.coalesce(((n["kind"] == "text") | (n["kind"] == "raw")) & (before["kind"] == n["kind"]) & (before["parent"] == n["parent"]), F.lit(False))

    def folded(doc: Column, n: Column, text: Column) -> Column:
        kept = F.exists(tagged(doc, *sorted(KEEP_SPACE_TAGS)), lambda k: holds(k, n))
        blank = text.rlike(rf"\A[{ASCII_SPACE}]+\z") & ~kept
        return F.when(blank, F.when(text.contains("\n"), "\n").otherwise(" ")).otherwise(text)

    def edit(doc: Column, joined: Column) -> Column:
        def texts(starts: Column) -> Column:
            def whole(n: Column, at: Column) -> Column:
                run = F.slice(doc, n + 1, F.coalesce(F.get(starts, at + 1), F.size(doc)) - n)
                return F.struct(n.alias("ord"), F.when(F.size(run) > 1, folded(doc, F.get(doc, n), F.array_join(run["text"], ""))).alias("text"))

            others = F.transform(joined, lambda o: F.struct(o.alias("ord"), F.lit(None).cast("string").alias("text")))
            return F.array_sort(F.concat(F.transform(starts, whole), others))

        starts = F.array_except(doc["ord"], joined)
        told = F.zip_with(doc, once(starts, texts), lambda n, t: F.struct(
            n["ord"].alias("ord"), n["end_ord"].alias("end_ord"), n["parent"].alias("parent"), n["depth"].alias("depth"),
            n["kind"].alias("kind"), n["tag"].alias("tag"), n["attrs"].alias("attrs"), F.coalesce(t["text"], n["text"]).alias("text")))
        left = once(covered(doc, single(joined)), lambda gone: F.filter(events(doc), lambda e: ~F.get(gone, e["ord"])))
        return once(told, lambda told: renumbered(told, left))

    joined = F.filter(doc, lambda n: goes_on(doc, n))["ord"]
    return once(joined, lambda joined: _edited(doc, F.size(joined) > 0, lambda doc: edit(doc, joined)))


STEPS = [lift_blocks, unpack_captions, unwrap_boxes, join_texts]


def with_rewritten(df: DataFrame, nodes: str = "nodes") -> DataFrame:
    """`nodes` after all repairs. Each step is a projection of its own, which keeps its expression small."""
    for step in _steps(df.sparkSession.sparkContext.applicationId, nodes):
        df = df.withColumn(nodes, step)
    return df


@cache
def _steps(application: str, nodes: str) -> list[Column]:
    """Long expressions take a while to write down, so this is done once."""
    return [once(plain_array(F.col(nodes)), step) for step in STEPS]


def rewritten_nodes(df: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """One row per node of the repaired document."""
    return with_rewritten(with_nodes(df, html)).select(*keys, F.inline("nodes"))
