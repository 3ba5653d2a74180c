"""HTML read by the standard library's parser inside Arrow-batched functions.

The parser is a fold over one page's tags, which no Spark expression can be; everything about the rows it
gives (joins, filters, ranks) is left to Spark.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Elements without text for readers, elements that break lines, elements without an end tag.
SILENT = {"head", "script", "style", "noscript", "iframe", "svg", "template"}
BLOCK = {"p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "ul", "ol", "table", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "form", "blockquote", "pre", "body", "html", "td", "th", "li", "br", "hr"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Pictures at most this wide and high are spacers.
SPACER_PIXELS = 1


class _Reader(HTMLParser):
    """Markdown lines, links and the title of one page."""

    def __init__(self, skipped: set[str]):
        super().__init__(convert_charrefs=True)
        self.skipped = skipped
        self.lines: list[str] = [""]
        self.links: list[tuple[str, str]] = []
        self.title = ""
        self.silent = 0
        self.stack: list[str] = []
        self.lists: list[list] = []
        self.href: str | None = None
        self.anchor: list[str] = []
        self.in_title = False

    def _selected(self, tag: str, attrs: dict) -> bool:
        names = {tag} | {f"#{attrs['id']}" for _ in (0,) if attrs.get("id")} | {f".{c}" for c in (attrs.get("class") or "").split()}
        return not names.isdisjoint(self.skipped)

    def _new_line(self) -> None:
        if self.lines[-1].strip():
            self.lines.append("")

    def handle_starttag(self, tag: str, attrs_list: list) -> None:
        attrs = dict(attrs_list)
        if tag == "title":
            self.in_title = True
        if tag in VOID:
            if tag == "br":
                self._new_line()
            elif tag == "img" and not self.silent:
                self._picture(attrs)
            return
        self.stack.append(tag)
        if self.silent or tag in SILENT or self._selected(tag, attrs):
            self.silent += 1
            return
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        if tag in BLOCK:
            self._new_line()
        if tag == "li":
            if self.lists:
                self.lists[-1][1] += 1
            mark = f"{self.lists[-1][1]}. " if self.lists and self.lists[-1][0] == "ol" else "- "
            self.lines[-1] += "  " * max(0, len(self.lists) - 1) + mark
        elif re.fullmatch("h[1-6]", tag):
            self.lines[-1] += "#" * int(tag[1]) + " "
        elif tag in ("b", "strong"):
            self.lines[-1] += "**"
        elif tag == "a":
            self.href, self.anchor = attrs.get("href"), []

    def _picture(self, attrs: dict) -> None:
        src = best_source(attrs.get("srcset")) or attrs.get("data-src") or attrs.get("src") or ""
        size = [int(v) if (v := re.sub(r"\D", "", attrs.get(k) or "")) else None for k in ("width", "height")]
        if src and not src.startswith("data:") and not all(v is not None and v <= SPACER_PIXELS for v in size):
            self.lines[-1] += f"![{attrs.get('alt') or ''}]({src})"

    def handle_endtag(self, tag: str) -> None:
        if tag == "title":
            self.in_title = False
        if tag in VOID or tag not in self.stack:
            return
        while self.stack:
            top = self.stack.pop()
            if self.silent:
                self.silent -= 1
            else:
                self._close(top)
            if top == tag:
                break

    def _close(self, tag: str) -> None:
        if tag in ("b", "strong"):
            self.lines[-1] += "**"
        elif tag == "a" and self.href is not None:
            text = " ".join("".join(self.anchor).split())
            self.links.append((self.href, text))
            self.lines[-1] += f"[{text}]({self.href})" if text else ""
            self.href = None
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        if tag in BLOCK:
            self._new_line()

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title += data
        if self.silent:
            return
        if self.href is not None:
            self.anchor.append(data)
            return
        if "pre" in self.stack:
            first, *others = data.split("\n")
            self.lines[-1] += first
            self.lines += others
            return
        text = re.sub(r"\s+", " ", data)
        line = self.lines[-1]
        self.lines[-1] += text.lstrip() if not line or line.endswith(" ") else text


_CANDIDATE = re.compile(r"\s*(\S*[^\s,])(?:\s+([\d.]+)([wx]))?\s*(?:,|$)")


def best_source(srcset: str | None) -> str | None:
    """The widest picture of a ``srcset``, else that of the highest density; commas within an address stay in it."""
    found = [(m[3] == "w", float(m[2]) if m[2] and m[2].count(".") < 2 else 1.0, m[1]) for m in _CANDIDATE.finditer(srcset or "")]
    kept = [c for c in found if not c[2].startswith("data:")]
    return max(kept, key=lambda c: c[:2])[2] if kept else None


def read(html: str, skipped: set[str] | None = None) -> _Reader:
    """``html`` read without the elements named by tag, ``#id`` or ``.class`` in ``skipped``."""
    reader = _Reader(skipped or set())
    reader.feed(html)
    reader.close()
    return reader


def page(html: str, skipped: set[str] | None = None) -> tuple[str, str]:
    """Markdown and title of the page, read once; if nothing is left without the skipped elements, of the whole page."""
    reader = read(html, skipped)
    text = "\n".join(x for x in (line.rstrip() for line in reader.lines) if x)
    return (text, reader.title.strip()) if text or not skipped else page(html)


def markdown(html: str, skipped: set[str] | None = None) -> str:
    return page(html, skipped)[0]
