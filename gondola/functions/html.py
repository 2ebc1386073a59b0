"""Pages as lines of text: a tokenizer that reads a page once, and the block structure of what it finds.

Tags, comments, declarations and raw elements (scripts, styles) are recognised as browsers do, unclosed ones included: a tag ends at the first `>` outside a
quoted value, and what is never closed reaches to the end of the page. Every step starts where the last one ended, so the time grows with the page.

Lines: blocks begin and end a line; paragraphs, headings, lists, tables, quotations and preformatted text stand apart by an empty line. Headings have a `#` per
level, list items a `*` or their number and two blanks per level of nesting, cells are separated by ` | `, a rule is `---`. Blanks are folded outside
preformatted text, entities (numeric ones, too) are decoded, scripts, styles and the title are left out."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Names of elements by what they do to lines.
RAW = {"script", "style", "title"}
APART = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "table", "blockquote", "pre"}
BLOCKS = APART | {
    "html", "head", "body", "div", "section", "article", "header", "footer", "main", "nav", "aside", "li", "dt", "dd", "tr", "thead", "tbody", "tfoot",
    "caption", "form", "fieldset", "legend", "figure", "figcaption", "address", "details", "summary", "hr", "br", "option", "center",
}

TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+>")
OPEN = re.compile(r"<(?:/?[A-Za-z]|[!?]|/)")
CLOSES = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.IGNORECASE) for name in RAW}


def tokens(page: str) -> Iterator[tuple[str, str]]:
    """(kind, value) in order: `text` with its text, `start` and `end` with the name of an element."""
    at, size = 0, len(page)
    while at < size:
        m = OPEN.search(page, at)
        if m is None:
            yield "text", unescape(page[at:])
            return
        if m.start() > at:
            yield "text", unescape(page[at:m.start()])
        at = m.start()
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        tag = TAG.match(page, at)
        if tag is None:  # a declaration, an end without a name, or a tag that is never closed
            end = page.find(">", at)
            at = size if end < 0 else end + 1
            continue
        name, at = tag.group(2).lower(), tag.end()
        if tag.group(1):
            yield "end", name
            continue
        yield "start", name
        if name in RAW:
            end = CLOSES[name].search(page, at)
            at = size if end is None else end.end()
            yield "end", name


class Lines:
    """Lines of a page, made from its tokens."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.held: list[str] = []
        self.prefix = ""
        self.apart = False
        self.lists: list[list] = []  # [name, items so far]
        self.cells = 0
        self.pre = 0

    def put(self, line: str) -> None:
        if self.apart and self.done:
            self.done.append("")
        self.done.append(line)
        self.apart = False

    def flush(self) -> None:
        """Ends the line at hand."""
        if self.pre:
            rows = "".join(self.held).split("\n")
            while rows and not rows[0].strip():
                rows.pop(0)
            while rows and not rows[-1].strip():
                rows.pop()
            for row in rows:
                self.put(row.rstrip())
        else:
            line = " ".join("".join(self.held).replace("\xa0", " ").split())
            if line.strip(" |"):
                self.put(self.prefix + line)
                self.prefix = ""
        self.held = []

    def start(self, name: str) -> None:
        if name in ("td", "th"):
            if self.cells:
                self.held.append(" | ")
            self.cells += 1
            return
        if name not in BLOCKS or (name == "br" and self.pre):
            if name == "br":
                self.held.append("\n")
            return
        self.flush()
        if name in APART and not (name in ("ul", "ol") and self.lists):
            self.apart = True
        if name in ("ul", "ol"):
            self.lists.append([name, 0])
        elif name == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.prefix = "  " * max(0, len(self.lists) - 1) + (f"{kind[1]}. " if kind[0] == "ol" else "* ")
        elif len(name) == 2 and name[0] == "h" and name[1] in "123456":
            self.prefix = "#" * int(name[1]) + " "
        elif name == "tr":
            self.cells = 0
        elif name == "hr":
            self.put("---")
        elif name == "pre":
            self.pre += 1

    def end(self, name: str) -> None:
        if name not in BLOCKS or name in ("br", "hr"):
            return
        self.flush()
        if name == "pre":
            self.pre = max(0, self.pre - 1)
        if name in ("ul", "ol") and self.lists:
            self.lists.pop()
        if name in ("li", "h1", "h2", "h3", "h4", "h5", "h6"):
            self.prefix = ""
        if name in APART and not (name in ("ul", "ol") and self.lists):
            self.apart = True


def text_of(page: str) -> str:
    out = Lines()
    for kind, value in tokens(page):
        if kind == "text":
            out.held.append(value)
        elif kind == "start":
            out.start(value)
        else:
            out.end(value)
    out.flush()
    return "\n".join(out.done)


def lines(page: Column) -> Column:
    """A column of pages as lines of text; null stays null."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else text_of(p) for p in pages], dtype=object)

    return run(page)
