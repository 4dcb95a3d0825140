"""HTML column -> Markdown column, within the row: no shuffle.

Python reads the HTML into a node array and resolves character references at the end; the repairs and the rendering
are column expressions. The starts and ends of a document's nodes are folded from left to right with the open
elements as state: an element's end takes its text from the stack, puts it into the form that its tag asks for, and
adds it to the element around it. What Markdown cannot say (embeds, merged-cell tables) stays HTML.
"""

from __future__ import annotations

from functools import cache
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.functions.text import SPACE, decode_references, once, strip, tidy_lines
from quillmill.operators.nodes import (
    HEADINGS, PRESERVED_TAGS, attr, code_language, code_text, events, first, inside, is_complex_table, is_tag, one_of, outer_html,
    parsed_html, tagged,
)
from quillmill.operators.rewrites import with_rewritten

NODES = "_nodes"
# Fixed values of the Markdown dialect.
BLOCK_TAGS = [*"p blockquote article div section ol ul li dl dt dd table thead tbody tfoot tr td th".split(), *HEADINGS]
VERBATIM_TAGS = ["pre", "code", "kbd", "samp"]
INLINE_ONLY_TAGS = ["td", "th"]
HEADING_TAG = r"\Ah\d+"
SPACES = r"[ \t\r\n]"
FRAME = ["ord", "tag", "first", "inline", "verbatim", "pre", "in_item", "done", "pieces", "tail", "before", "elements", "items"]
# Pieces of text that are joined into one, as every new piece costs a copy of the list of the others.
JOINED_PIECES = 128

# What a tag becomes: from its node, the text of its children, and the frame of the element around it.
Rule = Callable[[Column, Column, Column], Column]


class Place:
    """What rules may look at beside the node: the document, its starts and ends, and the node's own frame."""

    def __init__(self, doc: Column, line: Column, frame: Column, around: Column) -> None:
        self.doc, self.line, self.frame, self.around = doc, line, frame, around


def _text(value: str) -> Column:
    return F.lit(value)


def _starts(tag: Column) -> Column:
    return tag.rlike(HEADING_TAG)


def _spaces(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{SPACES}+|{SPACES}+\z", "")


def _indented(text: Column, indent: Column) -> Column:
    """Every line but the first one and blank ones moved to the right."""
    return F.replace(F.regexp_replace(text, r"\n(?=[^\n])", "\n\x00"), _text("\x00"), indent)


def _one_line(text: Column) -> Column:
    return F.regexp_replace(strip(text), rf"{SPACES}+", " ")


def _padded(text: Column, use: Callable[[Column], Column]) -> Column:
    """One outer space on either side survives the markers put around the text; nothing is left of a blank one."""
    before, after = F.when(text.startswith(" "), " ").otherwise(""), F.when(text.endswith(" "), " ").otherwise("")
    return once(strip(text), lambda core: F.when(core == "", "").otherwise(F.concat(before, use(core), after)))


def _block(text: Column, frame: Column, use: Callable[[Column], Column], blank: str = "") -> Column:
    """A block of its own; in cells and headings it stays in its line."""
    line = F.concat(_text(" "), text, _text(" "))
    return F.when(frame["inline"], line).otherwise(F.when(text == "", blank).otherwise(use(text)))


def _apart(text: Column) -> Column:
    return F.concat(_text("\n\n"), text, _text("\n\n"))


def _wrap(mark: str) -> Rule:
    def rule(node: Column, text: Column, frame: Column) -> Column:
        return F.when(frame["verbatim"], text).otherwise(_padded(text, lambda core: F.concat(_text(mark), core, _text(mark))))
    return rule


def _code(node: Column, text: Column, frame: Column) -> Column:
    def ticked(core: Column) -> Column:
        longest = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(core, _text("`+"), F.lit(0)), F.length)), F.lit(0))
        ticks, gap = F.repeat(_text("`"), longest + 1), F.when(longest > 0, " ").otherwise("")
        return F.concat(ticks, gap, core, gap, ticks)
    return F.when(frame["verbatim"], text).otherwise(_padded(text, ticked))


def _raised(tag: str) -> Rule:
    return lambda node, text, frame: once(strip(text), lambda core: F.when(core == "", "").otherwise(
        F.concat(_text(f"<{tag}>"), core, _text(f"</{tag}>"))))


def _titled(node: Column) -> Column:
    title = attr(node, "title")
    return F.when(title != "", F.concat(_text(' "'), F.replace(title, _text('"'), _text('\\"')), _text('"'))).otherwise("")


def _link(node: Column, text: Column, frame: Column) -> Column:
    href, core = attr(node, "href"), strip(text)
    same = (F.replace(core, _text("\\_"), _text("_")) == href) & (attr(node, "title") == "")
    linked = _padded(text, lambda core: F.concat(_text("["), core, _text("]("), href, _titled(node), _text(")")))
    return F.when(frame["verbatim"], text).when((core == "") | (href == ""), core).when(
        same, F.concat(_text("<"), href, _text(">"))).otherwise(linked)


def _image(node: Column, text: Column, frame: Column) -> Column:
    alt = attr(node, "alt")
    return F.when(frame["inline"], alt).otherwise(
        F.concat(_text("!["), alt, _text("]("), attr(node, "src"), _titled(node), _text(")")))


def _heading(node: Column, text: Column, frame: Column) -> Column:
    level = F.greatest(F.lit(1), F.least(F.lit(6), F.coalesce(F.regexp_extract(node["tag"], r"\Ah(\d{1,9})", 1).try_cast("int"), F.lit(6))))
    return F.when(frame["inline"], text).otherwise(_apart(F.concat(F.repeat(_text("#"), level), _text(" "), _one_line(text))))


def _quoted(node: Column, text: Column, frame: Column) -> Column:
    def quote(core: Column) -> Column:
        lines = F.regexp_replace(F.regexp_replace(core, r"\n(?=[^\n])", "\n> "), r"\n(?=\n)", "\n>")
        return F.concat(_text("\n> "), lines, _text("\n\n"))
    return once(_spaces(text), lambda core: _block(core, frame, quote, "\n"))


def _definition(node: Column, text: Column, frame: Column) -> Column:
    return once(strip(text), lambda core: _block(
        core, frame, lambda core: F.concat(_text(":   "), _indented(core, _text("    ")), _text("\n")), "\n"))


def _list(place: Place) -> Rule:
    def rule(node: Column, text: Column, frame: Column) -> Column:
        behind = F.filter(F.slice(place.doc, node["end_ord"] + 2, F.lit(4)), lambda n: n["depth"] == node["depth"])
        seen = F.filter(behind, lambda n: (n["kind"] == "element") | (~n["kind"].isin("comment", "doctype") & (strip(n["text"]) != "")))
        follows = F.coalesce(~one_of(first(seen)["tag"], ["ul", "ol"]), F.lit(False))
        nested = F.concat(_text("\n"), F.regexp_replace(text, rf"(?U)[{SPACE}]+\z", ""))
        return F.when(frame["in_item"], nested).otherwise(
            F.concat(_text("\n\n"), text, F.when(follows, "\n").otherwise("")))
    return rule


def _item(place: Place) -> Rule:
    def rule(node: Column, text: Column, frame: Column) -> Column:
        holder = F.get(place.doc, node["parent"])
        start = F.coalesce(F.regexp_extract(attr(holder, "start"), r"\A\d{1,9}\z", 0).try_cast("int"), F.lit(1))
        # The frame around has counted this item already.
        number = F.concat((start + frame["items"] - 1).cast("string"), _text(". "))
        bullet = F.when(F.coalesce(holder["tag"] == "ol", F.lit(False)), number).otherwise("- ")
        listed = lambda core: once(bullet, lambda mark: F.concat(
            mark, _indented(core, F.repeat(_text(" "), F.length(mark))), _text("\n")))
        return once(strip(text), lambda core: F.when(core == "", "\n").otherwise(listed(core)))
    return rule


def _span(cell: Column) -> Column:
    width = F.regexp_extract(attr(cell, "colspan"), r"\A\d{1,9}\z", 0).try_cast("int")
    return F.greatest(F.lit(1), F.coalesce(width, F.lit(1)))


def _cell(node: Column, text: Column, frame: Column) -> Column:
    return F.concat(_text(" "), F.replace(strip(text), _text("\n"), _text(" ")), F.repeat(_text(" |"), _span(node)))


def _row(place: Place) -> Rule:
    """A row; the first one also gets the dash line, under a blank header if it is no header."""
    def rule(node: Column, text: Column, frame: Column) -> Column:
        doc, holder = place.doc, F.get(place.doc, node["parent"])
        above = F.get(doc, holder["parent"])
        body = F.concat(_text("|"), text, _text("\n"))
        cells = tagged(inside(doc, node), "td", "th")
        width = F.aggregate(cells, F.lit(0), lambda total, c: total + _span(c))
        bars = lambda inner: F.concat(_text("| "), F.array_join(F.array_repeat(_text(inner), width), " | "), _text(" |\n"))
        rows = F.size(F.filter(inside(doc, holder), is_tag("tr")))
        heads = F.forall(cells, lambda c: c["tag"] == "th") | F.coalesce((holder["tag"] == "thead") & (rows == 1), F.lit(False))
        around = F.when(above.isNull(), doc).otherwise(inside(doc, above))
        in_body = F.coalesce(holder["tag"] == "tbody", F.lit(False))
        headless = ~in_body | ~F.exists(around, is_tag("thead")) | frame["first"]
        return F.when(~place.frame["first"], body).when(heads, F.concat(body, bars("---"))).when(
            headless, F.concat(bars(""), bars("---"), body)).otherwise(body)
    return rule


def preserve(place: Place) -> Rule:
    return lambda node, text, frame: _apart(strip(outer_html(place.doc, place.line, node, code_classes=True)))


def drop(place: Place) -> Rule:
    return lambda node, text, frame: _text("")


def unwrap(place: Place) -> Rule:
    return lambda node, text, frame: text


def _fence(place: Place) -> Rule:
    return lambda node, text, frame: F.concat(
        _text("\n\n```"), code_language(place.doc, node), _text("\n"), code_text(place.doc, node), _text("\n```\n\n"))


def _plain(rule: Rule) -> Callable[[Place], Rule]:
    return lambda place: rule


_box = _plain(lambda node, text, frame: once(strip(text), lambda core: _block(core, frame, _apart)))
RULES: dict[tuple[str, ...], Callable[[Place], Rule]] = {
    ("a",): _plain(_link), ("img",): _plain(_image), ("b", "strong"): _plain(_wrap("**")), ("em", "i"): _plain(_wrap("*")),
    ("del", "s"): _plain(_wrap("~~")), ("code", "kbd", "samp"): _plain(_code), ("sup",): _plain(_raised("sup")),
    ("sub",): _plain(_raised("sub")), ("q",): _plain(lambda node, text, frame: F.concat(_text('"'), text, _text('"'))),
    ("br",): _plain(lambda node, text, frame: F.when(frame["inline"], " ").otherwise("  \n")),
    ("hr",): _plain(lambda node, text, frame: _text("\n\n---\n\n")),
    ("p",): _plain(lambda node, text, frame: once(_spaces(text), lambda core: _block(core, frame, _apart))),
    ("div", "article", "section", "dl"): _box, ("blockquote",): _plain(_quoted), ("ul", "ol"): _list, ("li",): _item,
    ("dt",): _plain(lambda node, text, frame: once(_one_line(text), lambda core: _block(
        core, frame, lambda core: F.concat(_text("\n\n"), core, _text("\n")), "\n"))),
    ("dd",): _plain(_definition), ("table", "figcaption"): _plain(lambda node, text, frame: _apart(strip(text))),
    ("tr",): _row, ("td", "th"): _plain(_cell),
    ("caption",): _plain(lambda node, text, frame: F.concat(strip(text), _text("\n\n"))),
}
# Rules that look at the nodes only; what is inside needs no rendering.
NODE_RULES: dict[tuple[str, ...], Callable[[Place], Rule]] = {
    ("pre",): _fence, ("script", "style"): drop, tuple(PRESERVED_TAGS): preserve}
NAMED_RULES = {"preserve": preserve, "drop": drop, "unwrap": unwrap}


class Renderer:
    """The fold over one document; `overrides` come before the rules of the dialect."""

    def __init__(self, doc: Column, line: Column, overrides: dict[str, str | Rule]) -> None:
        self.doc, self.line = doc, line
        named = {(tag,): NAMED_RULES[rule] if isinstance(rule, str) else _plain(rule) for tag, rule in overrides.items()}
        whole = (preserve, drop)
        other = lambda rules: {tuple(t for t in tags if t not in overrides): rule for tags, rule in rules.items()}
        self.by_node = {tags: rule for tags, rule in (named | other(NODE_RULES)).items() if tags and (rule in whole or rule is _fence)}
        self.by_text = {tags: rule for tags, rule in (named | other(RULES)).items() if tags and rule not in whole}
        self.keeps_tables = "table" not in overrides

    def chosen(self, rules: dict, place: Place, node: Column, text: Column, default: Column) -> Column:
        for tags, rule in reversed(list(rules.items())):
            default = F.when(is_tag(*tags)(node), rule(place)(node, text, place.around)).otherwise(default)
        return default

    def whole(self, node: Column) -> Column:
        """Is the element made from its node alone?"""
        named = one_of(node["tag"], [tag for tags in self.by_node for tag in tags])
        return named | (((node["tag"] == "table") & is_complex_table(self.doc, node)) if self.keeps_tables else F.lit(False))

    def text(self) -> Column:
        none = F.array().cast("array<string>")
        nothing = F.lit(False)
        root = self.frame(F.lit(-1), F.lit(""), nothing, nothing, nothing, nothing, nothing, none, none)
        start = F.struct(F.lit(-1).alias("whole"), F.lit(-1).alias("skip"), F.array(root).alias("open"))
        end = lambda state: once(F.try_element_at(state["open"], F.lit(1)), self.all_text)
        return F.aggregate(self.line, start, self.step, end)

    @staticmethod
    def all_text(frame: Column) -> Column:
        return F.concat(F.array_join(frame["done"], ""), F.array_join(frame["pieces"], ""), frame["tail"])

    @staticmethod
    def frame(ord, tag, first, inline, verbatim, pre, in_item, done, pieces) -> Column:
        """An open element, what being inside it implies, the pieces of its text and the newlines after them, the tag of
        the last child (null: none, blank: a leaf), and how many elements and list items it has had."""
        values = [ord, tag, first, inline, verbatim, pre, in_item, done, pieces, _text(""), F.lit(None).cast("string"), F.lit(0), F.lit(0)]
        return F.struct(*[value.alias(name) for name, value in zip(FRAME, values, strict=True)])

    def step(self, state: Column, event: Column) -> Column:
        skipped = (event["ord"] >= state["whole"]) & (event["ord"] <= state["skip"])
        return F.when(skipped, state).otherwise(once(F.get(self.doc, event["ord"]), lambda node: once(
            F.element_at(state["open"], -1), lambda top: self.next(state, top, node, event["close"]))))

    def next(self, state: Column, top: Column, node: Column, close: Column) -> Column:
        """An element that is opened goes onto the stack; anything else ends in a piece of text for the frame around it."""
        element, tag = node["kind"] == "element", node["tag"]
        rest = lambda number: F.slice(state["open"], 1, F.size(state["open"]) - number)

        def opened() -> Column:
            none = F.expr("cast(array() AS array<string>)")
            fresh = self.frame(
                node["ord"], tag, top["elements"] == 0, top["inline"] | one_of(tag, INLINE_ONLY_TAGS) | _starts(tag),
                top["verbatim"] | one_of(tag, VERBATIM_TAGS), top["pre"] | (tag == "pre"), top["in_item"] | (tag == "li"), none, none)
            return F.struct(state["whole"].alias("whole"), state["skip"].alias("skip"), F.concat(rest(1), F.array(self.counted(top, tag), fresh)).alias("open"))

        def piece(around: Column, whole: Column) -> Column:
            place = Place(self.doc, self.line, top, around)
            of_text = lambda text: self.chosen(
                self.by_text, place, node, text, F.when(_starts(tag), _heading(node, text, around)).otherwise(text))
            of_node = self.chosen(self.by_node, place, node, _text(""), preserve(place)(node, _text(""), around))
            leaf = F.when(one_of(node["kind"], ["comment", "doctype"]), "").otherwise(self.leaf_text(top, node))
            return F.when(close, once(self.all_text(top), of_text)).when(whole, of_node).otherwise(leaf)

        def added(around: Column, whole: Column) -> Column:
            told = once(piece(around, whole), lambda piece: self.joined(around, piece))
            # The end of an element has been counted at its start.
            counted = once(told, lambda f: F.when(close, f).otherwise(self.counted(f, tag)))
            return F.struct(
                F.when(whole, node["ord"]).otherwise(state["whole"]).alias("whole"),
                F.when(whole, node["end_ord"]).otherwise(state["skip"]).alias("skip"),
                F.concat(rest(F.when(close, 2).otherwise(1)), F.array(counted)).alias("open"))

        def told(whole: Column) -> Column:
            around = F.when(close, F.element_at(state["open"], -2)).otherwise(top)
            return F.when(element & ~close & ~whole, opened()).otherwise(once(around, lambda around: added(around, whole)))

        whole = element & ~close & self.whole(node)
        return F.when(close & ~element, state).otherwise(once(whole, told))

    def counted(self, f: Column, tag: Column) -> Column:
        """The frame with one more child, a leaf if it has no tag."""
        return self.changed(f, before=tag, elements=f["elements"] + (tag != "").cast("int"), items=f["items"] + (tag == "li").cast("int"))

    @staticmethod
    def changed(f: Column, **fields: Column) -> Column:
        return F.struct(*[(fields[name] if name in fields else f[name]).alias(name) for name in FRAME])

    def joined(self, frame: Column, piece: Column) -> Column:
        """The frame with a piece of text; newlines that meet become the larger run, two at most, but for code."""
        lead = F.regexp_extract(piece, r"\A\n*", 0)

        def with_parts(lead: Column) -> Column:
            rest = F.substr(piece, F.length(lead) + 1)
            tail = F.length(rest) - F.length(F.rtrim(rest, _text("\n")))
            met = F.repeat(_text("\n"), F.least(F.lit(2), F.greatest(F.length(lead), F.length(frame["tail"]))))
            met = F.when((lead != "") & (frame["tail"] != ""), met).otherwise(F.concat(frame["tail"], lead))
            return once(tail, lambda tail: self.with_text(
                frame, F.concat(met, F.left(rest, F.length(rest) - tail)), F.repeat(_text("\n"), tail)))

        whole = self.with_text(frame, F.concat(frame["tail"], piece), _text(""))
        return F.when(piece == "", frame).when(frame["pre"], whole).otherwise(once(lead, with_parts))

    def with_text(self, f: Column, piece: Column, tail: Column) -> Column:
        full = F.size(f["pieces"]) >= JOINED_PIECES
        done = F.when(full, F.array_append(f["done"], F.array_join(f["pieces"], ""))).otherwise(f["done"])
        pieces = F.when(full, F.array(piece)).otherwise(F.array_append(f["pieces"], piece))
        return self.changed(f, done=done, pieces=pieces, tail=tail)

    def leaf_text(self, top: Column, node: Column) -> Column:
        """A text with the whitespace at the edges of blocks gone."""
        inside_of = lambda tag: one_of(tag, BLOCK_TAGS) | _starts(tag)
        outside_of = lambda tag: F.coalesce((tag == "pre") | inside_of(tag), F.lit(False))
        after = F.get(self.doc, node["ord"] + 1)
        after_tag = F.when(after["depth"] == node["depth"], after["tag"])
        at_start = outside_of(top["before"]) | (inside_of(top["tag"]) & top["before"].isNull())
        at_end = outside_of(after_tag) | (inside_of(top["tag"]) & after_tag.isNull())
        runs = F.regexp_replace(F.regexp_replace(node["text"], r"[\t ]*[\r\n][\t \r\n]*", "\n"), r"[\t ]{2,}|\t", " ")
        text = F.when(top["pre"], node["text"]).otherwise(runs)

        def cut(edges: Column) -> Column:
            left = F.when(edges["at_start"], F.regexp_replace(text, rf"\A{SPACES}+", "")).otherwise(text)
            right = F.when(edges["at_end"], F.regexp_replace(left, rf"(?U)[{SPACE}]+\z", "")).otherwise(left)
            return F.when((edges["at_start"] | edges["at_end"]) & (strip(node["text"]) == ""), "").otherwise(right)

        return once(F.struct(at_start.alias("at_start"), at_end.alias("at_end")), cut)


def rendered(nodes: Column, overrides: dict[str, str | Rule] | None = None) -> Column:
    """Markdown of a repaired document's nodes, before its lines are tidied."""
    return once(nodes, lambda doc: once(events(doc), lambda line: Renderer(doc, line, overrides or {}).text()))


@cache
def _rendering(application: str) -> Column:
    """The rules of the dialect without overrides. It takes seconds to write down, so this is done once."""
    return rendered(F.col(NODES))


def html_to_markdown(
    df: DataFrame, html: str = "content_html", *, overrides: dict[str, str | Rule] | None = None
) -> DataFrame:
    """Add `markdown` and `error` (null unless the HTML could not be read and was kept).

    `overrides` maps a tag to "preserve", "drop", "unwrap" or a function of columns (node, text of its children, frame
    of the element around it) -> text. Blank HTML is not read.
    """
    blank = F.coalesce(strip(F.col(html)) == "", F.lit(True))
    parsed = df.withColumn("_parsed", parsed_html(F.when(~blank, F.col(html))))
    repaired = with_rewritten(parsed.withColumn(NODES, F.col("_parsed.nodes")), NODES)
    rendering = rendered(F.col(NODES), overrides) if overrides else _rendering(df.sparkSession.sparkContext.applicationId)
    # Exploding one value keeps Spark from copying the whole rendering to every place that looks at its result.
    made = repaired.select("*", F.explode(F.array(rendering)).alias("_markdown"))
    made = made.withColumn("_markdown", decode_references(F.col("_markdown")))
    error = F.col("_parsed.error")
    return made.withColumns({
        "markdown": F.when(blank, "").when(error.isNull(), tidy_lines(F.col("_markdown"))).otherwise(F.col(html)),
        "error": error,
    }).drop("_parsed", NODES, "_markdown")


def conversion_issues(converted: DataFrame) -> DataFrame:
    """`html_conversion_error` issues; `seq` puts them behind the issues of reading."""
    return converted.where("error IS NOT NULL").select(
        "feed_path", "entry_index", F.lit(100).alias("seq"), F.lit("error").alias("severity"),
        F.lit("html_conversion_error").alias("issue_type"), F.col("id").alias("post_id"),
        F.col("title").alias("post_title"), F.col("error").alias("message"),
    )
