"""Main text of web pages by union-free regular expressions (wrappers) of their hosts.

The token stream of a page is its tags, with text reduced to slots.  Repetitions next to each
other are folded into repeated groups, so a page becomes an expression without unions:
sequence, optional, repeated, slot.  The expressions of a host are aligned one after another;
what only one of them has becomes optional, what one repeats and the other has once becomes
repeated.  The result, the host's wrapper, describes all its pages.

A wrapper's slots are judged by where they stand (elements for navigation and the like are left
out) and by the host's pages.  What stands inside an article is kept, but for branches named as
adverts, comments and the like that hold the smaller part of the text; names of what holds the
article do not count where the page has no other.  On pages without text in an article, unwanted
names are left out where other slots hold text, and all such pages of the host decide: slots whose text is the same on all of
them, or mostly links, are left out, and of the rest the part of the page with most text stays.

All pages count: equal expressions of a host are merged while they are shuffled, and the
different ones are aligned in bounded groups, again and again, until a host has one.

Defined cases: a null or empty page has an empty text; a page without a host forms a host of
its own with others like it; pages that cannot be parsed whole are read as far as they go;
repeated rows are extracted one by one.

Pages with elements that are never closed, or nested without end, are read whole: below DEEPEST
open elements the text belongs to the deepest one.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscope.sources import stage_table

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?P<raw>script|style|textarea|noscript|template|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<[!?][^>]*>|<(?P<end>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav footer aside button select option input label menu dialog title head".split())
# whole tokens of class, id and role, and of nothing else
UNWANTED = frozenset(
    "nav navbar navigation main-nav site-nav top-nav nav-menu menu main-menu mainmenu topmenu footer site-footer page-footer foot "
    "sidebar side-bar left-sidebar right-sidebar site-header page-header masthead banner ad ads advert adverts advertisement advertising "
    "adsense ad-banner ad-container ad-slot promo promotion sponsor sponsored sponsors cookie cookies cookie-notice cookie-banner "
    "cookie-consent consent popup modal newsletter newsletter-signup subscribe subscription comment comments comment-list commentlist "
    "comments-area comment-form comment-respond respond disqus disqus_thread replies share sharing share-buttons share-bar social "
    "social-links social-share social-media related related-posts related-articles related-content breadcrumb breadcrumbs pagination "
    "pager login login-form search search-form search-box searchbox widget-area complementary contentinfo".split())
ARTICLES = frozenset("main main-content maincontent article article-body article-content articlebody post-content entry-content".split())
CLOSED_BY = {
    "p": frozenset("p div ul ol dl table article section aside nav header footer form h1 h2 h3 h4 h5 h6 pre blockquote main".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
CHANGING = re.compile(r"^(?:tag|category|cat|author|term|topic)-.*|[_-]*\d.*$", re.S)
SLOT = "#"
LONGEST = 32  # tokens of a group that folding looks for
DEEPEST = 150  # open block elements; a page that is never closed goes no deeper
ALIGN_CELLS = 1_000_000  # pairs of siblings from which they are matched in order


def _marks(values: str) -> str:
    """Tokens of class, id and role without what numbers or names the page: post-123 is post, tag-news nothing."""
    return " ".join(sorted({t for t in (CHANGING.sub("", v) for v in values.lower().split()) if t}))


def page_tokens(html: str | None) -> list[tuple[str, str]]:
    """("open", label), ("close", tag) and ("text", raw) in page order; scripts and comments are left out."""
    found, at = [], 0
    html = html or ""
    for match in TOKEN.finditer(html):
        if match.start() > at:
            found.append(("text", html[at : match.start()]))
        at = match.end()
        tag = match["tag"]
        if tag:
            tag = tag.lower()
            if match["end"]:
                found.append(("close", tag))
            else:
                rest = match["rest"]
                marks = _marks(" ".join(v.strip("\"'") for _, v in ATTRIBUTE.findall(rest))) if rest else ""
                found.append(("open", f"{tag} {marks}" if marks else tag))
    if at < len(html):
        found.append(("text", html[at:]))
    return found


def located(html: str | None) -> Iterator[tuple[str, tuple[str, ...], str]]:
    """(kind, path of open block elements, value): "text" with the raw text, "edge" where a block begins or ends.

    Elements that are never closed end where the next one of their kind, or their parent, does.
    Below DEEPEST open elements no more are opened: what they hold belongs to the deepest one.
    """
    path: list[str] = []
    beyond: dict[str, int] = {}  # elements that were not opened, by tag
    links = 0
    for kind, value in page_tokens(html):
        tag = value.split(" ", 1)[0]
        if kind == "text":
            yield ("link" if links else "text"), tuple(path), value
        elif tag in INLINE:
            if tag == "a":
                links = max(0, links + (1 if kind == "open" else -1))
            elif tag == "br":
                yield "text", tuple(path), " "
        elif kind == "open":
            while path and tag in CLOSED_BY.get(path[-1].split(" ", 1)[0], ()):
                path.pop()
            links = 0
            if tag not in VOID and len(path) >= DEEPEST:
                beyond[tag] = beyond.get(tag, 0) + 1
                yield "text", tuple(path), " "
                continue
            yield "edge", tuple(path), value
            if tag not in VOID:
                path.append(value)
        elif beyond.get(tag):
            beyond[tag] -= 1
            links = 0
            yield "text", tuple(path), " "
        else:
            depth = next((i for i in range(len(path) - 1, -1, -1) if path[i].split(" ", 1)[0] == tag), None)
            links = 0
            if depth is not None:
                del path[depth:]
                beyond.clear()
            yield "edge", tuple(path), "/" + tag


# An expression is a list of items: SLOT, an element ["e", label, items], ["+", items] repeated
# or ["?", items] optional.  The tokens between an element's begin and its end are its items,
# so groups hold whole elements only.


def _name(item) -> tuple:
    """What has to agree for two items to be one: the outer labels, whether repeated or not."""
    if item == SLOT:
        return (SLOT,)
    return (item[1],) if item[0] == "e" else tuple(n for part in item[1] for n in _name(part))


def fold(items: list) -> list:
    """Fold repetitions that stand next to each other, the shortest first, until none is left."""
    items = [item if item == SLOT else ["e", item[1], fold(item[2])] if item[0] == "e" else item for item in items]
    changed = True
    while changed:
        changed = False
        for size in range(1, min(LONGEST, len(items) // 2) + 1):
            out, i = [], 0
            while i < len(items):
                body, times = items[i : i + size], 1
                while len(body) == size and items[i + times * size : i + (times + 1) * size] == body:
                    times += 1
                last = out[-1] if out else SLOT
                if times > 1:
                    # a group beside itself is one group, two slots are one slot
                    out += body if size == 1 and (body[0] == SLOT or body[0][0] == "+") else [["+", body]]
                    i, changed = i + times * size, True
                elif last[0] == "+" and items[i : i + len(last[1])] == last[1]:
                    i, changed = i + len(last[1]), True  # one more copy of the group before it
                else:
                    out.append(items[i])
                    i += 1
            items = out
    return items


def expression(html: str | None) -> list:
    """The folded expression of one page: block elements and slots, in page order."""
    open_items: list[list] = [[]]
    for kind, path, value in located(html):
        del open_items[len(path) + 1 :]
        if kind == "edge":
            if not value.startswith("/"):
                element = ["e", value, []]
                open_items[-1].append(element)
                if _tag(value) not in VOID:
                    open_items.append(element[2])
        elif value.strip() and open_items[-1][-1:] != [SLOT]:
            open_items[-1].append(SLOT)
    return fold(open_items[0])


def _merged(x, y):
    if x == y:
        return x
    if x[0] == y[0] == "e":
        return ["e", x[1], align(x[2], y[2])]
    bodies = [item[1] if item[0] in "+?" else [item] for item in (x, y)]
    kinds = {item[0] for item in (x, y)} & {"+", "?"}
    body = align(*bodies)
    return ["?", [["+", body]]] if len(kinds) == 2 else [kinds.pop(), body]


def _aligned_in_order(a: list, b: list, x: list, y: list) -> list:
    """Very many siblings: each is matched with the next of its name on the other side, in linear time.

    The common sequence need not be the longest; what is not in it is optional on either side.
    """
    where: dict[tuple, list[int]] = {}
    for j in range(len(y) - 1, -1, -1):
        where.setdefault(y[j], []).append(j)
    optional = lambda item: item if item != SLOT and item[0] == "?" else ["?", [item]]
    out, done = [], 0
    for i, name in enumerate(x):
        places = where.get(name, [])
        while places and places[-1] < done:
            places.pop()
        if places and places[-1] - done <= len(x) - i + 64:  # a match far ahead would leave too much behind
            out += [optional(item) for item in b[done : places[-1]]] + [_merged(a[i], b[places[-1]])]
            done = places.pop() + 1
        else:
            out.append(optional(a[i]))
    return out + [optional(item) for item in b[done:]]


def align(a: list, b: list) -> list:
    """The expression that describes what either describes: the longest common sequence, the rest optional."""
    x, y = [_name(item) for item in a], [_name(item) for item in b]
    if len(x) * len(y) > ALIGN_CELLS:
        return fold(_aligned_in_order(a, b, x, y))
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0

    def optional(item) -> None:
        out.append(item if item != SLOT and item[0] == "?" else ["?", [item]])

    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append(_merged(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and best[i + 1][j] >= best[i][j + 1]):
            optional(a[i])
            i += 1
        else:
            optional(b[j])
            j += 1
    return fold(out)


def slot_paths(wrapper: list) -> list[tuple[str, ...]]:
    """The paths of the block elements around each slot of a wrapper, in order, each once."""
    found: dict[tuple[str, ...], None] = {}

    def walk(items: list, path: tuple[str, ...]) -> None:
        for item in items:
            if item == SLOT:
                found.setdefault(path)
            elif item[0] == "e":
                walk(item[2], (*path, item[1]))
            else:
                walk(item[1], path)

    walk(wrapper, ())
    return list(found)


def _tag(label: str) -> str:
    return label.split(" ", 1)[0]


def _named(label: str) -> bool:
    """Whether an element may hold something else than main text, by whole tokens of its class, id and role."""
    tag, _, marks = label.partition(" ")
    return tag == "form" or (tag not in ("html", "body", "article", "main") and not UNWANTED.isdisjoint(marks.split()))


def _article_at(path: tuple[str, ...]) -> int | None:
    """The place of the outermost element that marks an article."""
    for i, label in enumerate(path):
        tag, _, marks = label.partition(" ")
        if tag in ("article", "main") or (tag not in ("html", "body") and not ARTICLES.isdisjoint(marks.split())):
            return i
    return None


def kind_of(path: tuple[str, ...]) -> int | None:
    """0 in an article, 1 in one that stands in a container with an unwanted name, 2 elsewhere, None not main text by its element."""
    at = _article_at(path)
    around = path if at is None else path[:at]
    if any(_tag(label) in ASIDE for label in path) or any(_tag(label) == "header" for label in around):
        return None
    return 2 if at is None else int(any(_named(label) for label in around))


Facts = dict[str, tuple[int, int, int, bool]]  # joined path: pages, characters, characters in links, text always the same


def article_paths(paths: list[tuple[str, ...]], facts: Facts) -> list[str]:
    """The slots that are main text on pages with text in an article, as joined paths.

    ``facts`` has the slots of these pages that stand in articles.  A branch inside an article with
    an unwanted name is left out if it has less than half of the text, or is mostly links.
    """
    chars: dict[tuple[str, ...], int] = {}
    links: dict[tuple[str, ...], int] = {}
    mine = [p for p in paths if " > ".join(p) in facts]
    for path in mine:
        _, n, linked, _ = facts[" > ".join(path)]
        for depth in range(len(path) + 1):
            chars[path[:depth]] = chars.get(path[:depth], 0) + n
            links[path[:depth]] = links.get(path[:depth], 0) + linked

    def other(branch: tuple[str, ...]) -> bool:
        return 2 * chars[branch] < chars[()] or 2 * links[branch] > chars[branch]

    return [" > ".join(p) for p in mine
            if not any(_named(p[i]) and other(p[: i + 1]) for i in range(_article_at(p) + 1, len(p)))]


def fallback_paths(paths: list[tuple[str, ...]], facts: Facts) -> list[str]:
    """The slots that are main text on pages without text in an article, as joined paths.

    ``facts`` has the slots of these pages.  Unwanted names count where others hold text.
    """
    mine = [p for p in paths if " > ".join(p) in facts]
    return _largest_part([p for p in mine if not any(map(_named, p))], facts) or _largest_part(mine, facts)


def _largest_part(wanted: list[tuple[str, ...]], facts: Facts) -> list[str]:
    kept = []
    for path in wanted:
        pages, chars, linked, constant = facts[" > ".join(path)]
        if not (constant and pages > 2) and 2 * linked <= chars:
            kept.append((path, chars))
    if not kept:
        return []
    # the element below the body that holds most of the text, and what shares it
    weight: dict[tuple[str, ...], int] = {}
    for path, chars in kept:
        for depth in range(1, len(path) + 1):
            weight[path[:depth]] = weight.get(path[:depth], 0) + chars
    total = sum(chars for _, chars in kept)
    root = max((p for p, w in weight.items() if 2 * w >= total), key=len, default=())
    while root and _tag(root[-1]) in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td"):
        root = root[:-1]
    return [" > ".join(path) for path, _ in kept if path[: len(root)] == root]


def main_text(html: str | None, content: frozenset[str]) -> str:
    """The blocks of the given slots, in page order."""
    blocks, now = [], []

    def finish() -> None:
        text = " ".join(entities.unescape("".join(now)).split())
        if text:
            blocks.append(text)
        now.clear()

    for kind, path, value in located(html):
        if kind == "edge":
            finish()
        elif " > ".join(path) in content:
            now.append(value)
    finish()
    return "\n\n".join(blocks)


def page_text(html: str | None, *choices: frozenset[str]) -> str:
    """The main text by the first of ``choices`` that has any on the page."""
    return next((text for text in (main_text(html, content) for content in choices) if text), "")


def host_of(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame, group: int = 256) -> DataFrame:
    """(host, content, held, fallback): for every host the joined paths of main text on pages of each ``kind_of``."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, html in zip(batch["host"], batch["html"], strict=True):
                html = html if isinstance(html, str) else ""
                slots: dict[str, list] = {}
                kinds: dict[str, int | None] = {}
                with_text = set()
                for kind, path, value in located(html):
                    if kind != "edge" and value.strip():
                        joined = " > ".join(path)
                        slots.setdefault(joined, []).append((kind, value))
                        if joined not in kinds:
                            kinds[joined] = kind_of(path)
                        if kinds[joined] not in with_text and entities.unescape(value).strip():
                            with_text.add(kinds[joined])
                of_page = min(with_text - {None}, default=None)
                facts = [{"path": p, "kind": of_page, "chars": sum(len(v) for _, v in s), "linked": sum(len(v) for k, v in s if k == "link"),
                          "text": blake2b(" ".join("".join(v for _, v in s).split()).encode("utf-8", "replace"), digest_size=16).hexdigest()}
                         for p, s in slots.items() if kinds[p] == of_page is not None]
                rows.append((host, json.dumps(expression(html)), facts))
            yield pd.DataFrame(rows, columns=["host", "wrapper", "facts"])

    schema = "host string, wrapper string, facts array<struct<path:string,kind:int,chars:long,linked:long,text:string>>"
    described = stage_table(pages.select("host", "html").mapInPandas(describe, schema), "page-expressions")

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        wrapper = None
        for text in sorted(frame["wrapper"], key=lambda w: (-len(w), w)):
            other = json.loads(text)
            wrapper = other if wrapper is None else align(wrapper, other)
        return pd.DataFrame({"host": [key[0]], "wrapper": [json.dumps(wrapper)]})

    wrappers = stage_table(described.select("host", "wrapper").distinct(), "wrappers")
    while True:
        sizes = wrappers.groupBy("host").agg(F.count("*").alias("n")).filter("n > 1")
        most = sizes.agg(F.max("n")).first()[0]
        if most is None:
            break
        parts = F.when(F.col("n") > group, F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / (group / 2)))).otherwise(0)
        several = wrappers.join(sizes, "host").withColumn("part", parts)
        merged = several.groupBy("host", "part").applyInPandas(merge, "host string, wrapper string").distinct()
        alone = wrappers.join(sizes, "host", "left_anti")
        wrappers = stage_table(alone.unionByName(merged), "wrappers")
    facts = (
        described.select("host", F.explode("facts").alias("f")).groupBy("host", "f.path", "f.kind")
        .agg(F.count("*").alias("pages"), F.sum("f.chars").alias("chars"), F.sum("f.linked").alias("linked"),
             (F.min("f.text") == F.max("f.text")).alias("constant"))
        .groupBy("host").agg(F.collect_list(F.struct("path", "kind", "pages", "chars", "linked", "constant")).alias("facts"))
    )

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for host, wrapper, facts in zip(batch["host"], batch["wrapper"], batch["facts"], strict=True):
                paths, known = slot_paths(json.loads(wrapper)), ({}, {}, {})
                for f in facts if facts is not None else []:
                    known[f["kind"]][f["path"]] = (f["pages"], f["chars"], f["linked"], f["constant"])
                found.append((host, article_paths(paths, known[0]), article_paths(paths, known[1]), fallback_paths(paths, known[2])))
            yield pd.DataFrame(found, columns=["host", "content", "held", "fallback"])

    return stage_table(
        wrappers.join(facts, "host", "left").mapInPandas(
            decide, "host string, content array<string>, held array<string>, fallback array<string>"), "wrapper-content")


def extract_text(pages: DataFrame) -> DataFrame:
    """Add ``text`` and ``n_chars`` to page_id and url."""
    hosted = pages.select("page_id", "url", "html").withColumn("host", host_of("url"))
    content = infer_wrappers(hosted.select("host", "html"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                page_text(html, *(frozenset(c) if c is not None else frozenset() for c in choices)) if isinstance(html, str) else ""
                for html, *choices in zip(batch["html"], batch["content"], batch["held"], batch["fallback"], strict=True)]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    joined = hosted.withColumn("page_id", F.col("page_id").cast("string")).join(content, "host", "left")
    texts = joined.select("page_id", "url", "html", "content", "held", "fallback").mapInPandas(run, "page_id string, url string, text string")
    return texts.withColumn("page_id", F.col("page_id").cast(pages.schema["page_id"].dataType)).withColumn(
        "n_chars", F.length("text").cast("long"))
