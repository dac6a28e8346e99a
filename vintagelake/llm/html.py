"""Main text of HTML pages by line-block distribution.

Markup is stripped so that every block element becomes one line; parts that
are not article text (scripts, styles, menus, headers, footers, sidebars,
notices, adverts, forms, comments, by tag, role, or class and id words) leave
no line, so they are no distance.  A word that also names a topic counts only
with a second one; headings are not stripped by words.  Over the line lengths
a window of ``WINDOW`` lines is summed.  Text surges where a window reaches
``SURGE`` characters and dives where the lines of a whole window are empty;
the lines from each surge to its dive are kept, with those before it back to
the first heading or paragraph since the last dive.  If nothing surges, all runs
between dives stand for them.  A page with article or main elements only
counts the text in them, and keeps every such part.  On other pages, parts
more than ``WINDOW * 8`` empty lines from the rest go if they are much shorter
than the longest (under ``SHARE`` of it).

Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one newline in page order.  A null or
empty page, and one without text, give the empty string.  Unclosed, truncated
or stray tags are tolerated.  Rows are kept one to one.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SURGE, SHARE = 3, 40, 0.2

# Element names of HTML.
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "select", "option", "object",
        "canvas", "math", "xmp", "noembed", "noframes", "head"}
_ASIDE = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "label", "figcaption"}
_BLOCK = {"p", "div", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt",
          "dd", "table", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "blockquote", "pre", "figure", "hr",
          "br", "address", "details", "summary", "center", "body", "html"} | _ASIDE
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
_MAIN = {"article", "main"}
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
# class and id words of parts without article text; _TOPICS may as well name what a section is about
_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored",
          "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
          "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "sidebar", "aside", "widget",
          "comment", "comments", "reply", "replies", "respond", "discussion", "disqus", "menu", "nav", "navbar",
          "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "header", "masthead", "footer", "copyright",
          "share", "sharing", "social", "related", "recommended", "toolbar", "search", "form", "skip", "legal", "tags"}
_TOPICS = {"header", "notice", "notices", "alert", "modal", "overlay", "consent", "subscription", "promotion", "widget",
           "comment", "reply", "replies", "respond", "discussion", "aside", "related", "recommended", "search", "form",
           "skip", "legal", "tags", "share", "social", "banner", "login", "signup"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


def _aside(name: str, attrs: str) -> bool:
    """Whether an element holds no article text."""
    if name in _ASIDE:
        return True
    if not attrs or name in ("body", "html", "article", "main") and "class" not in attrs and "id" not in attrs:
        return False
    found = set()
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id") and name not in ("body", "html", "main", "h1", "h2", "h3", "h4", "h5", "h6"):
            words = _WORDS.intersection(w.lower() for w in _PART.findall(value))
            # ids of sections come from their titles
            if words - _TOPICS and (key == "class" or name != "section"):
                return True
            found |= words
    return len(found) > 1


def blocks(page: str) -> tuple[list[str], list[bool], bool]:
    """One line per block, whether it is of a heading or paragraph, and whether only article or main elements count;
    no line for a stripped part."""
    lines: list[str] = []
    held: list[str] = []
    inside: list[bool] = []
    prose: list[bool] = []
    stack: list[tuple[str, bool]] = []
    skip = mains = 0
    raw = None

    def flush(stripped: bool):
        text = _SPACE.sub(" ", entities.unescape("".join(held))).strip()
        held.clear()
        if text or not stripped:
            lines.append(text)
            inside.append(mains > 0)
            prose.append(next((n for n, _ in reversed(stack) if n in _BLOCK), "") in _PROSE)

    for m in _TOKEN.finditer(page):
        name = m[2]
        if name is None:
            s = m[0]
            if raw is None and not skip and s[0] != "<":
                held.append(s)
            elif s.startswith("<![CDATA[") and raw is None and not skip:
                held.append(s[9:-3])
            elif s == "<" and raw is None and not skip:
                held.append("&lt;")
            continue
        name, closing = name.lower(), bool(m[1])
        if raw is not None:
            if closing and name == raw:
                raw = None
            continue
        if name in _RAW:
            # inside such an element only its own end tag counts
            if not closing and name != "head" and not m[3].endswith("/"):
                raw = name
            continue
        off = not closing and name not in _VOID and _aside(name, m[3])
        if name in _BLOCK:
            flush(off or skip > 0)
        if name in _VOID:
            continue
        if not closing:
            if name == "p" and stack and stack[-1][0] == "p":
                skip -= stack.pop()[1]
            if m[3].endswith("/") and name not in _BLOCK:
                continue
            stack.append((name, off))
            skip += off
            mains += name in _MAIN and not skip
        else:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None and (name in _BLOCK or all(n not in _BLOCK for n, _ in stack[at + 1:])):
                for n, off in stack[at:]:
                    skip -= off
                    if n in _MAIN and not skip and not off:
                        mains = max(0, mains - 1)
                del stack[at:]
    flush(skip > 0)
    if marked := any(i and t for i, t in zip(inside, lines)):
        lines = [t if i else "" for i, t in zip(inside, lines)]
    return lines, prose, marked


def main_text(page: str | None) -> str:
    """The text between surge and dive points."""
    lines, prose, marked = blocks(page) if page else ([], [], False)
    size = [len(t) for t in lines]
    window = [sum(size[i:i + WINDOW]) for i in range(len(size))]
    for least in (SURGE, 1):
        parts: list[list[int]] = []
        before: list[int] = []
        on = False
        for i, n in enumerate(window):
            if not on and n >= least:
                parts.append(before)
                on = True
            if not n:
                on, before = False, []
            elif size[i]:
                if on:
                    parts[-1].append(i)
                elif before or prose[i]:
                    before.append(i)
        if parts:
            break
    if not marked:
        near: list[list[int]] = []
        for part in parts:
            if not near or part[0] - near[-1][-1] > WINDOW * 8:
                near.append([])
            near[-1] += part
        weight = [sum(size[i] for i in part) for part in near]
        parts = [part for part, w in zip(near, weight) if w >= SHARE * max(weight)]
    return "\n".join(lines[i] for part in parts for i in part)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``."""
    def run(batches):
        for b in batches:
            text = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
