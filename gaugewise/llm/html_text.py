"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each at a root-to-leaf path of block elements. Per path, text length and punctuation
are summed over its blocks (text in links counts against it); a path's ratio is smoothed over the paths that share its
parent and grandparent, fused with what the element names and classes on the path say, and paths above a share of the
page's best are content. Class words of furniture weigh against an element, unless it holds the article or nearly all of
the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP_SHARE = 0.2
SUSPECT = 0.02  # weight of a path for each element on it that is classed as furniture
WRAPPER = 9  # an element classed as furniture wraps the page if it holds this many times the plain text outside it
NEAR = tuple(math.exp(-d * d / 2) for d in range(3))  # weights of the path itself, its siblings, its parent's siblings
PUNCTUATION = re.compile(r"[.,;:!?。，！？；]")

# Element names and class words of HTML pages.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head script style noscript template iframe object svg math canvas nav header footer aside form button select textarea "
    "menu dialog audio video".split()
)
CLOSED_BY_BLOCK = frozenset(["p"])
OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = frozenset("ul ol dl table".split())
ARTICLE = frozenset(["article", "main"])
BAD_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|menus?|nav\w*|breadcrumbs?|sidebars?|side|footer|header|masthead|comments?|"
    r"commentlist|replies|respond|disqus|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|overlay|newsletter|subscribe|subscription|"
    r"signup|login|share|sharing|social|related|recommended|widgets?|pagination|pager|toolbar|search|copyright|legal|hidden|skip)(?=$|[\s_-])",
    re.I,
)
GOOD_WORD = re.compile(r"(?:^|[\s_-])(?:article\w*|content|post|entry|story|main|text|body)(?=$|[\s_-])", re.I)
BAD_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
BARE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
READ = frozenset(["class", "id", "role", "hidden", "aria-hidden"])
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
LAYOUT_WORD = re.compile(r"(?:^|(?<=\s))(?:has|no|with|without)[_-]\S*", re.I)  # says what is beside or inside the element
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea", "noscript", "iframe", "template", "title", "svg")}


def tags(page: str) -> Iterator[re.Match[str]]:
    """Tags, comments and declarations in page order, each character read a bounded number of times.

    A quote that never closes is met once: from then on a tag ends at the next `>`, quotes or not.
    """
    last, broken = page.rfind(">"), False
    at = page.find("<")
    while at >= 0:
        found = None
        if page.startswith(("<!--", "<![CDATA["), at):
            found = TAG.match(page, at)
        elif at < last:
            found = (BARE_TAG if broken and page[at + 1 : at + 2] not in "!?" else TAG).match(page, at)
            if found is None and not broken and BARE_TAG.match(page, at):
                broken = True
                found = BARE_TAG.match(page, at)
        if found:
            yield found
        at = page.find("<", found.end() if found else at + 1)


def _label(name: str, attributes: str, number: int, in_article: bool = False) -> str:
    """The element's part of a path: its name, and `!` if it is furniture, `+` if it is the article, `^` if named like content.

    `~` and the element's number follow where only a class or id names it like furniture; an article named so (a reader's
    comment, a teaser) is none. The header inside an article is its head, not the page's.
    """
    if name in DROPPED and not (name == "header" and in_article):
        return name + "!"
    mark, bad = "+" if name in ARTICLE else "", False
    if attributes and name not in ("html", "body"):
        for kind, *values in ATTRIBUTE.findall(attributes):
            if (kind := kind.lower()) not in READ:
                continue
            value = next((v for v in values if v), "")
            if kind == "role":
                if value.lower() in BAD_ROLE:
                    return name + "!"
                mark = "+" if value.lower() in ("main", "article") else mark
            elif kind == "hidden" or (kind == "aria-hidden" and value.strip().lower() == "true"):
                return name + "!"
            elif kind in ("class", "id"):
                value = CAMEL.sub("-", value)
                bad = bad or BAD_WORD.search(LAYOUT_WORD.sub("", value)) is not None
                if not mark and GOOD_WORD.search(value):
                    mark = "^"
    return f"{name}{mark.replace('+', '')}~{number}" if bad and (mark != "+" or name == "article") else name + mark


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(path, text, characters in links) of the page's blocks in page order; white space is one space, none is empty."""
    names: list[str] = []
    path: list[str] = []
    parts: list[str] = []
    state = {"links": 0, "link": 0}

    def flush() -> list[tuple[tuple[str, ...], str, int]]:
        text = " ".join(html.unescape("".join(parts)).split())
        links, state["links"] = state["links"], 0
        parts.clear()
        # an element repeated inside itself adds nothing, so that unclosed elements do not make paths without end
        return [(tuple(x for k, x in enumerate(path) if not k or path[k - 1] != x), text, links)] if text else []

    def close(k: int) -> None:
        del names[k:], path[k:]

    at, end, skip_to = 0, len(page), -1
    for tag in tags(page):
        if tag.start() < skip_to:
            continue
        if tag.start() > at:
            said = page[at : tag.start()]
            parts.append(said)
            if state["link"]:
                state["links"] += len(said.strip())
        at = tag.end()
        if tag[2] is None:
            if tag[0].startswith("<![CDATA["):
                parts.append(html.escape(tag[0][9:-3]))
            continue
        closing, name = bool(tag[1]), tag[2].lower()
        if name == "a":
            state["link"] = 0 if closing else 1
        if name == "br":
            parts.append(" ")
        if name in INLINE or (name in VOID and name != "hr"):
            continue
        yield from flush()
        if name == "hr":
            continue
        if closing:
            for k in range(len(names) - 1, -1, -1):
                if names[k] == name:
                    close(k)
                    break
            continue
        state["link"] = 0
        if names and names[-1] in CLOSED_BY_BLOCK:
            close(len(names) - 1)
        if name in OWN_KIND:
            for k in range(len(names) - 1, -1, -1):
                if names[k] in OWN_KIND[name]:
                    close(k)
                    break
                if names[k] in LIMITS:
                    break
        if name == "body" and "head" in names:
            close(names.index("head"))
        if tag[3].rstrip().endswith("/") and name in RAW:
            continue
        if name in RAW:
            stop = RAW[name].search(page, at)
            at = skip_to = stop.end() if stop else end
            continue
        names.append(name)
        path.append(_label(name, tag[3], tag.start(), any(x.endswith("+") for x in path)))
    if at < end:
        parts.append(page[at:])
    yield from flush()


def path_scores(found: list[tuple[tuple[str, ...], str, int]]) -> dict[tuple[str, ...], float]:
    """Each path's smoothed ratio: text outside links per block, raised by punctuation, averaged with near paths."""
    sums: dict[tuple[str, ...], list[float]] = defaultdict(lambda: [0.0, 0.0])
    for path, text, links in found:
        marks = len(PUNCTUATION.findall(text))
        for key in {path, (*path[:-1], "*"), (*path[:-2], "**")}:
            total = sums[key]
            total[0] += max(0, len(text) - links) * (1 + marks / (1 + len(text) / 40))
            total[1] += 1
    out = {}
    for path in {p for p, _, _ in found}:
        near = [sums[path], sums[(*path[:-1], "*")], sums[(*path[:-2], "**")]]
        out[path] = sum(w * n[0] / n[1] for w, n in zip(NEAR, near, strict=True)) / sum(NEAR)
    return out


def _weighed(found: list[tuple[tuple[str, ...], str, int]]) -> list[tuple[tuple[str, ...], str, int]]:
    """The blocks with `~` and no number on the elements that count as furniture, and neither on those that wrap the page."""
    inside: dict[str, int] = defaultdict(int)
    wraps: set[str] = set()
    for path, text, links in found:
        for k, x in enumerate(path):
            if "~" in x:
                inside[x] += max(0, len(text) - links)
                # holds an article that is not itself inside one: an article's list of comments holds comments
                if any(y.endswith("+") for y in path[k + 1 :]) and not any(y.endswith("+") for y in path[:k]):
                    wraps.add(x)
    for x in sorted(inside, key=lambda x: (-inside[x], int(x[x.index("~") + 1 :]))):
        plain = sum(max(0, len(t) - n) for p, t, n in found if x not in p and not any("~" in y and y not in wraps for y in p))
        if x not in wraps and inside[x] < max(1, WRAPPER * plain):
            break
        wraps.add(x)

    def named(path: tuple[str, ...]) -> tuple[str, ...]:
        new = [x[: x.index("~") + (x not in wraps)] if "~" in x else x for x in path]
        return tuple(x for k, x in enumerate(new) if not k or new[k - 1] != x)

    return [(named(path), text, links) for path, text, links in found]


def main_text(page: str | None) -> str:
    """The page's content blocks, joined by an empty line; '' if there are none."""
    found = _weighed([b for b in blocks(page or "") if not any(x.endswith("!") for x in b[0])])
    if not found:
        return ""
    suspects = lambda path: sum(x.endswith("~") for x in path)
    marked = {path for path, _, _ in found if any(x.endswith("+") for x in path) and not suspects(path)}
    scores = path_scores(found)
    named = lambda path: (2.0 if any("^" in x for x in path) else 1.0) * SUSPECT ** suspects(path)
    fused = {path: score * named(path) for path, score in scores.items()}
    least = KEEP_SHARE * max(fused.values())
    # a page that marks its article is taken by it: what the article holds is content at any length, and what is outside
    # it is none, unless there is more content outside (articles in a list of others beside an unmarked main text)
    held = [0, 0]
    for path, text, links in found:
        if path in marked or fused[path] >= least:
            held[path in marked] += max(0, len(text) - links)
    fused = {path: math.inf if path in marked else 0.0 if held[1] and held[0] <= held[1] else score for path, score in fused.items()}
    return "\n\n".join(text for path, text, _ in found if fused[path] >= max(least, 1e-9))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        lengths = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    `pages` holds page_id, url and html; more columns are ignored. NULL, empty and wholly markup pages have the text ''.
    Rows that repeat a page_id each get a row. Empty input gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
