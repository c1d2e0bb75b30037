"""HTML to Markdown with the standard library's parser, in an Arrow function.

Rules.  Scripts, styles, templates and the page's title are left out; all other
text stays, wherever it is.  A template that is never closed is none: its text stays too.  End tags may be missing: the head ends where
something begins that a head can't hold, and blocks, items, cells and rows end where
the next one begins.  A table's first row is its header row.  Every line of a quotation has its mark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..arrow import in_bytes, ready

_SKIPPED = frozenset({"script", "style", "template"})
_BLOCKS = {"p", "div", "article", "section", "footer", "header", "main", "nav", "form", "ul", "ol", "dl", "pre", "blockquote", "dt", "dd", "aside", "figure", "address", "center", "caption"}
_MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "kbd": "`", "samp": "`", "del": "~~", "s": "~~"}


class _Writer(HTMLParser):
    def __init__(self, skipped: frozenset[str] = _SKIPPED) -> None:
        super().__init__(convert_charrefs=True)
        self.skipped = skipped
        self.out: list[str] = []
        self.skip = self.pre = 0
        self.title = False
        self.lists: list[int] = []  # the next number, or -1 for bullets
        self.links: list[tuple[str | None, int]] = []
        self.tables: list[_Table] = []
        self.quotes: list[int] = []  # where open quotations begin

    def block(self, lines: int = 2) -> None:
        self.out.append("\n" * lines)

    def end_row(self) -> None:
        """Write the open row of the innermost table in one line, and the rule under a first row."""
        table = self.tables[-1]
        if table.cells:
            row = re.sub(r"\s+", " ", "".join(self.out[table.begin :])).strip()
            rule = "\n|" + " --- |" * table.cells if not table.rows else ""
            self.out[table.begin :] = [f"\n{row} |{rule}"]
            self.links = [x for x in self.links if x[1] < table.begin]
            table.rows += 1
            table.cells = 0

    def end_quote(self) -> None:
        """Mark the lines of the innermost quotation."""
        begin = self.quotes.pop()
        lines = _tidy("".join(self.out[begin:])).split("\n")
        self.out[begin:] = ["\n".join(f"> {x}".rstrip() if not x.endswith("  ") else f"> {x}" for x in lines)] if any(lines) else []
        self.links = [x for x in self.links if x[1] < begin]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in self.skipped:
            self.skip += 1
        if self.skip:
            return
        self.title = tag == "title"
        if re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "br":
            self.out.append("  \n")
        elif tag == "hr":
            self.out.append("\n\n---\n\n")
        elif tag == "li":
            depth = "  " * max(len(self.lists) - 1, 0)
            mark = "* "
            if self.lists and self.lists[-1] >= 0:
                mark = f"{self.lists[-1]}. "
                self.lists[-1] += 1
            self.out.append(f"\n{depth}{mark}")
        elif tag in ("ul", "ol"):
            self.block(1 if self.lists else 2)
            self.lists.append(1 if tag == "ol" else -1)
        elif tag == "table":
            self.block()
            self.tables.append(_Table())
        elif tag in ("tr", "td", "th") and self.tables:
            if tag == "tr":
                self.end_row()
            else:
                table = self.tables[-1]
                if not table.cells:
                    table.begin = len(self.out)
                self.out.append(" | " if table.cells else "| ")
                table.cells += 1
        elif tag == "a":
            self.links.append((dict(attrs).get("href"), len(self.out)))
        elif tag == "img":
            own = dict(attrs)
            self.out.append(f"![{own.get('alt') or ''}]({own.get('src') or ''})")
        elif tag in _MARKS:
            self.out.append(_MARKS[tag])
        elif tag in _BLOCKS:
            self.block()
            if tag == "pre":
                self.pre += 1
                self.out.append("```\n")
            elif tag == "blockquote":
                self.quotes.append(len(self.out))

    def handle_endtag(self, tag: str) -> None:
        if tag in self.skipped:
            self.skip = max(self.skip - 1, 0)
        if self.skip:
            return
        self.title = False
        if re.fullmatch("h[1-6]", tag):
            self.block()
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.block(1 if self.lists else 2)
        elif tag in ("tr", "table") and self.tables:
            self.end_row()
            if tag == "table":
                self.tables.pop()
                self.block()
        elif tag == "a" and self.links:
            href, at = self.links.pop()
            words = "".join(self.out[at:])
            if href and words.strip():
                self.out[at:] = [f"[{words.strip()}]({href})"]
        elif tag in _MARKS:
            self.out.append(_MARKS[tag])
        elif tag in _BLOCKS:
            if tag == "pre":
                self.pre = max(self.pre - 1, 0)
                self.out.append("\n```")
            elif tag == "blockquote" and self.quotes:
                self.end_quote()
            self.block()

    def handle_data(self, data: str) -> None:
        if not self.skip and not self.title:
            self.out.append(data if self.pre else re.sub(r"\s+", " ", data))

    def finish(self) -> str:
        self.close()
        while self.tables:
            self.end_row()
            self.tables.pop()
        while self.quotes:
            self.end_quote()
        return "".join(self.out)


class _Table:
    """An open table: rows written, cells of the open row, and where that row begins."""

    rows = cells = begin = 0


def to_markdown(html: str | None) -> str:
    """Markdown of a page."""
    writer = _Writer()
    writer.feed(html or "")
    text = writer.finish()
    if writer.skip and re.search("<template", html, re.I):  # one that is never closed is none
        writer = _Writer(_SKIPPED - {"template"})
        writer.feed(html)
        text = writer.finish()
    return _tidy(text)


def _tidy(text: str) -> str:
    """Lines without blanks that mean nothing: two at a line's end are a line break, others there, and one at its start, are not meant."""
    lines = text.split("\n")
    text = "\n".join((x.rstrip() if x.startswith("  ") else x.strip()) + "  " * (x.endswith("  ") and bool(x.strip())) for x in lines)
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n ")


def html_to_markdown(html: Column) -> Column:
    ready()

    @F.arrow_udf("string")
    def convert(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for (some,) in in_bytes((x,) for x in pages):
            yield pa.array(map(to_markdown, some), pa.string())

    return convert(html)
