"""HTML read leniently into the columns of a node table.

Nothing is implied: an unclosed tag nests what follows, an end tag closes up to the nearest
open tag of that name, a stray end tag is ignored and void tags close at once.
"""

from __future__ import annotations

from html import entities
from html.parser import HTMLParser

# Fixed values of HTML.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
    "nextid param source spacer track wbr".split()
)
# Text inside these is not part of a document's own text; the first two hold no markup at all.
RAW_TEXT_TAGS = frozenset(["script", "style", "template", "rt", "rp"])
UNESCAPED_TAGS = frozenset(["script", "style"])
KEEP_SPACE_TAGS = frozenset(["pre", "textarea"])
LIST_ATTRIBUTES = frozenset(["class", "accesskey", "dropzone"])
LIST_ATTRIBUTES_OF = {
    "a": {"rel", "rev"},
    "link": {"rel", "rev"},
    "td": {"headers"},
    "th": {"headers"},
    "form": {"accept-charset"},
    "object": {"archive"},
    "area": {"rel"},
    "icon": {"sizes"},
    "iframe": {"sandbox"},
    "output": {"for"},
}
ASCII_SPACE = " \n\t\f\r"
MARKS = {"comment": ("<!--", "-->"), "doctype": ("<!DOCTYPE ", ">\n"), "cdata": ("<![CDATA[", "]]>"),
         "declaration": ("<!", ">"), "instruction": ("<?", ">")}


class NodeReader(HTMLParser):
    """Rows of the nodes of one document, in document order: an element, or a leaf of kind text, raw (script and the
    like) or one of `MARKS`."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.rows: dict[str, list] = {name: [] for name in ("end_ord", "parent", "depth", "kind", "tag", "attrs", "text")}
        self.stack: list[int] = []
        self.open: dict[str, int] = {}
        self.buffer: list[str] = []

    def add(self, kind: str, tag: str = "", attrs: dict[str, str] | None = None, text: str = "") -> int:
        at = len(self.rows["kind"])
        values = (at, self.stack[-1] if self.stack else -1, len(self.stack) + 1, kind, tag, attrs or {}, text)
        for column, value in zip(self.rows.values(), values):
            column.append(value)
        return at

    def inside(self, tags: frozenset[str]) -> bool:
        return not tags.isdisjoint(self.open) and any(self.open.get(tag) for tag in tags)

    def flush(self, kind: str = "text") -> None:
        if not self.buffer:
            return
        text = "".join(self.buffer)
        self.buffer.clear()
        if kind == "text":
            text = fold_blank(text, self.inside(KEEP_SPACE_TAGS))
            kind = "raw" if self.inside(RAW_TEXT_TAGS) else "text"
        self.add(kind, text=text)

    def handle_starttag(self, tag, attrs, closed=False):
        self.flush()
        own_lists = LIST_ATTRIBUTES_OF.get(tag, ())
        values = {
            name: " ".join((value or "").split()) if name in LIST_ATTRIBUTES or name in own_lists else value or ""
            for name, value in attrs
        }
        at = self.add("element", tag, values)
        if not closed and tag not in VOID_TAGS:
            self.stack.append(at)
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        self.flush()
        while self.open.get(tag):
            if self.end_last() == tag:
                break

    def end_last(self) -> str:
        at = self.stack.pop()
        tag = self.rows["tag"][at]
        self.rows["end_ord"][at] = len(self.rows["kind"]) - 1
        self.open[tag] -= 1
        return tag

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_charref(self, name):
        self.buffer.append(_numbered(name))

    def handle_entityref(self, name):
        # An unknown name is literal text, without the semicolon the scanner has eaten.
        self.buffer.append(entities.html5.get(name + ";") or entities.html5.get(name) or "&" + name)

    def _mark(self, kind: str, text: str) -> None:
        self.flush()
        self.buffer.append(text)
        self.flush(kind)

    def handle_comment(self, data):
        self._mark("comment", data)

    def handle_decl(self, decl):
        kind = "doctype" if decl[:7].lower() == "doctype" else "declaration"
        self._mark(kind, decl[7:].strip() if kind == "doctype" else decl)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self._mark("cdata", data[6:])
        else:
            self._mark("declaration", data)

    def handle_pi(self, data):
        self._mark("instruction", data)


def _numbered(name: str) -> str:
    try:
        point = int(name[1:], 16) if name[0] in "xX" else int(name)
        if point < 256:
            try:
                return bytes([point]).decode("windows-1252")
            except UnicodeDecodeError:
                pass
        # A lone surrogate cannot be written as UTF-8.
        return "\N{REPLACEMENT CHARACTER}" if 0xD800 <= point <= 0xDFFF else chr(point)
    except (ValueError, OverflowError):
        return "\N{REPLACEMENT CHARACTER}"


def fold_blank(text: str, keep_space: bool) -> str:
    """ASCII-blank text becomes one newline or one space, except where spaces are kept."""
    if not keep_space and text[:1] in ASCII_SPACE and not text.strip(ASCII_SPACE):
        return "\n" if "\n" in text else " "
    return text


def read_nodes(text: str) -> dict[str, list]:
    """Columns of the document's nodes; the number of a node is its place in them."""
    reader = NodeReader()
    reader.feed(text)
    reader.close()
    reader.flush()
    while reader.stack:
        reader.end_last()
    return reader.rows
