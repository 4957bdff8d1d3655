"""Web pages to markdown that keeps their structure (O-15).

One pass over a page's tags with a stack of open elements, run over Arrow batches as a
``convert.convert_with`` plug-in or by ``convert_structured``. Kept are headings,
paragraphs, line breaks, nested lists (numbered ones count), links, images, emphasis,
inline code, ``pre`` blocks as fences with their white space, quotes, and tables with a
separator row below the first row. ``head``, scripts, styles and comments go.

Elements that are never closed end with what holds them; a closing tag without an
opening one is ignored; an attribute that is missing leaves the plain text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SKIPPED = {"script", "style", "head", "template", "noscript"}
_BLOCKS = {"p", "div", "section", "article", "nav", "header", "footer", "main", "aside", "body", "html", "form", "figure", "dl", "dt", "dd"}
_MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*"}


class _Page(HTMLParser):
    """Collects lines; ``open`` is the stack of (tag, state) of elements that matter."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.line = ""
        self.open: list[tuple[str, dict]] = []

    def _state(self, *tags: str) -> dict | None:
        return next((s for t, s in reversed(self.open) if t in tags), None)

    def _end_line(self, blank: bool = False) -> None:
        text = self.line.rstrip()
        if text.strip():
            self.lines.append("> " * sum(t == "blockquote" for t, _ in self.open) + text)
        if blank and self.lines and self.lines[-1]:
            self.lines.append("")
        self.line = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        at = dict(attrs)
        if self._state("pre") is not None and tag != "pre":
            return
        if re.fullmatch("h[1-6]", tag):
            self._end_line(True)
            self.line = "#" * int(tag[1]) + " "
        elif tag in ("ul", "ol"):
            self._end_line(self._state("li") is None)
            self.open.append((tag, {"n": 0}))
        elif tag == "li":
            self._close("li", inside=("ul", "ol"))
            self._end_line()
            of = self._state("ul", "ol")
            depth = sum(t in ("ul", "ol") for t, _ in self.open)
            number = next((t for t, _ in reversed(self.open) if t in ("ul", "ol")), "ul") == "ol"
            if of is not None:
                of["n"] += 1
            self.line = "  " * max(0, depth - 1) + (f"{of['n']}. " if number else "- ")
            self.open.append((tag, {}))
        elif tag == "a" and at.get("href"):
            self.open.append((tag, {"href": at["href"]}))
            self.line += "["
        elif tag == "img" and at.get("src"):
            self.line += f"![{at.get('alt') or ''}]({at['src']})"
        elif tag == "pre":
            self._end_line(True)
            self.open.append((tag, {"text": ""}))
        elif tag == "code":
            self.open.append((tag, {}))
            self.line += "`"
        elif tag in _MARKS:
            self.open.append((tag, {"at": len(self.line)}))
        elif tag == "table":
            self._end_line(True)
            self.open.append((tag, {"rows": 0}))
        elif tag == "tr":
            self._close("tr", inside=("table",))
            self._end_line()
            self.open.append((tag, {"cells": 0}))
        elif tag in ("td", "th"):
            row = self._state("tr")
            if row is not None:
                row["cells"] += 1
                self.line += "| " if row["cells"] == 1 else " | "
        elif tag == "br":
            self._end_line()
        elif tag == "hr":
            self._end_line(True)
            self.lines += ["---", ""]
        elif tag in _SKIPPED or tag == "blockquote":
            self._end_line(True)
            self.open.append((tag, {}))
        elif tag in _BLOCKS and not re.fullmatch(r" *(-|\d+\.) ", self.line):  # a list item may begin with a block
            self._end_line(self._state("li", "td", "th") is None)

    def handle_endtag(self, tag: str) -> None:
        if re.fullmatch("h[1-6]", tag) or tag in _BLOCKS:
            self._end_line(self._state("li", "td", "th") is None)
        elif any(t == tag for t, _ in self.open):
            if tag == "blockquote":
                self._end_line()  # while the quote is still open
            self._close(tag)

    def _close(self, tag: str, inside: tuple[str, ...] = ()) -> None:
        """Close the innermost ``tag`` and all that it holds; with ``inside``, only if it is within the innermost of those."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                break
            if self.open[i][0] in inside:
                return
        else:
            return
        while len(self.open) > i:
            self._finish(*self.open.pop())

    def _finish(self, tag: str, state: dict) -> None:
        if tag == "a":
            self.line = self.line.rstrip() + f"]({state['href']})"
        elif tag == "code":
            self.line += "`"
        elif tag in _MARKS:
            body = self.line[state["at"]:] if len(self.line) >= state["at"] else ""
            if body.strip():
                kept = body.strip()
                self.line = self.line[:state["at"]] + body.replace(kept, _MARKS[tag] + kept + _MARKS[tag], 1)
        elif tag == "pre":
            self.lines += ["```", *state["text"].strip("\n").split("\n"), "```", ""]
        elif tag == "tr":
            if state["cells"]:
                self.line += " |"
                cells = state["cells"]
                self._end_line()
                table = self._state("table")
                if table is not None:
                    table["rows"] += 1
                    if table["rows"] == 1:
                        self.lines.append("|" + "---|" * cells)
        elif tag in ("ul", "ol", "table", "blockquote"):
            self._end_line(not any(t in ("ul", "ol", "table") for t, _ in self.open))
        elif tag == "li":
            self._end_line()

    def handle_data(self, data: str) -> None:
        pre = self._state("pre")
        if pre is not None:
            pre["text"] += data
        elif not any(t in _SKIPPED for t, _ in self.open):
            text = re.sub(r"[ \t\n\r\f]+", " ", data)
            self.line += text.lstrip() if not self.line.strip() and not self.line.endswith(("- ", ". ", "# ")) else text

    def markdown(self) -> str:
        self.close()
        while self.open:
            self._finish(*self.open.pop())
        self._end_line()
        return re.sub(r"\n{3,}", "\n\n", "\n".join(self.lines)).strip(" \t\n\r\f")


def to_markdown(html: str) -> str:
    page = _Page()
    page.feed(html)
    return page.markdown()


def converter(content: bytes | str, name: str) -> tuple[str | None, str | None]:
    """The same as a ``convert.convert_with`` plug-in; bytes that are not UTF-8 are read as Latin-1."""
    if content is None:
        return None, "no content"
    if isinstance(content, (bytes, bytearray)):
        try:
            content = bytes(content).decode()
        except UnicodeDecodeError:
            content = bytes(content).decode("latin-1")
    return to_markdown(content) or None, None


def convert_structured(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """``id, markdown, error``: null markdown and an error for a page that is null or holds nothing."""
    from corpusflow.operators.chunking import ensure_parallelism
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [converter(h, "") for h in pdf[html_col]]
            yield pd.DataFrame({id_col: pdf[id_col], "markdown": [m for m, _ in made],
                                "error": [e or (None if m else "empty conversion") for m, e in made]})

    return ensure_parallelism(pages.select(F.col(id_col), html_col)).mapInPandas(run, f"{id_col} {kind}, markdown string, error string")
