"""Operator 8, HTML extraction by composite text density.

Every element of a page gets its characters per tag, lowered by the share of characters in
links; the sum of its children's densities tells where long texts lie side by side.  The element
with the largest sum is the heart of the page.  The smallest density on its way up to the body is
the page's threshold: branches at or above it are searched for more content.  Scripts, styles and
other raw elements are left out beforehand; elements whose tag or class names them as menus, forms, adverts, notices or reader comments are left out if
they are no wrapper of the article: one that holds an ``h1``, ``main`` or ``article`` that is not named so itself, or a form with half of the page's
text, stays.  A class counts by its whole words or known compounds (``site-footer``, not ``no-sidebar``), and words that articles use as well
(``related``, ``share``, ``notice``) only on containers that are short or full of links.  If the heart lies in an ``article`` or
``main`` element, that whole element is the content; otherwise headings of the first rank ahead of the content belong to it, and a short
line of copyright at the end does not.

A page is one row; rows are not shuffled and each is parsed in one pass.

Defined results: null, empty or text-free html gives an empty text; broken markup is read as
browsers do (unclosed paragraphs end at the next block, unknown end tags are skipped, a text
after a lone ``<`` is text); repeated rows give equal rows; other columns stay; an empty
table gives no rows; the input may not have a ``text`` or ``n_chars`` column.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import register, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas".split())
NEVER = frozenset("button select head".split()) | RAW
#: Elements that are not the article unless they are wrapped around it.
SELDOM = frozenset("nav footer aside form dialog menu".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr "
                   "ul").split())
#: Words of class or id that name other things than the article.
OTHER = frozenset(("ad ads adv advert advertisement adverts breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
                   "footer masthead menu modal nav navbar navigation newsletter pagination paywall popup promoted "
                   "sidebar sponsor sponsored").split())
#: Words that name other things, or a part of an article.
PERHAPS = frozenset("banner notice overlay promo promotion related share sharing signup social subscribe toolbar widget".split())
#: Words that go with those in compounds; any other word beside them makes a name of its own.
BESIDE = frozenset(("area bar block body bottom box button buttons center col column container content desktop fixed form global group header inline inner item items "
                    "label leaderboard left line link links list main media mini mobile outer page panel placeholder post posts primary rail reply right row secondary section site "
                    "slot small sticky story stories tail text thread title tools top unit wrap wrapper article articles").split())
CONTAINERS = frozenset("div section ul ol dl table header aside form nav footer details fieldset".split())
CLOSES_P = BLOCK - {"html", "body", "caption", "legend", "summary", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dd", "dt"} | {"li", "dd", "dt"}
SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>|<[a-zA-Z][^>]*>""", re.S)
#: A whole attribute, with its value; quoted text that no name precedes is one match without a name.
ATTRIBUTE = re.compile(r""""[^"]*"|'[^']*'|([^\s/>"'=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


ENDS = {tag: re.compile(rf"</{tag}[\s>/]", re.I) for tag in RAW}
COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b).{0,160}", re.I)


class _Element:
    __slots__ = ("tag", "parts", "other", "perhaps", "within", "chars", "tags", "link_chars", "link_tags", "density", "sum", "parent")

    def __init__(self, tag: str, parent: _Element | None, other: bool, perhaps: bool):
        self.tag, self.parent, self.other, self.perhaps, self.parts = tag, parent, other, perhaps, []
        self.within = parent is not None and (parent.within or parent.tag in ("article", "main"))


def _named_other(name: str, words: frozenset[str]) -> bool:
    """Whether a class or id is one of the words or a known compound of them."""
    parts = [x for x in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if x]
    return any(x in words for x in parts) and all(x in OTHER or x in PERHAPS or x in BESIDE for x in parts)


def _is_other(tag: str, attributes: str, within: bool) -> tuple[bool, bool]:
    """Whether an element is named as something else than the article, and as something that may be."""
    other, perhaps = tag in NEVER or tag in SELDOM or tag == "header" and not within, False
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "role" and value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog"):
            other = True
        elif name in ("class", "id"):
            for said in value.split():
                if tag in ("article", "main"):
                    other = other or _named_other(said, _COMMENT)
                elif tag not in ("html", "body"):
                    other = other or _named_other(said, OTHER)
                    perhaps = perhaps or tag in CONTAINERS and _named_other(said, PERHAPS)
    return other, perhaps


_COMMENT = frozenset(("comment", "comments"))


def parsed(page: str) -> tuple[_Element, list[_Element]]:
    """The root and all elements, parents first; text and children in order in ``parts``."""
    root = _Element("html", None, False, False)
    stack, order, at, open_tags = [root], [root], 0, Counter()

    def cut(i: int) -> None:
        open_tags.subtract(x.tag for x in stack[i:])
        del stack[i:]

    while m := TOKEN.search(page, at):
        if m.start() > at:
            stack[-1].parts.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in ("article", "main", "table", "body") and tag not in BLOCK:
                    break
            continue
        if tag == "html" or tag == "body" and open_tags[tag]:
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1) if open_tags["p"] else ():
                if stack[i].tag == "p":
                    cut(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in SAME:
            ends, fence = SAME[tag]
            for i in range(len(stack) - 1, 0, -1) if any(open_tags[x] for x in ends) else ():
                if stack[i].tag in ends:
                    cut(i)
                    break
                if stack[i].tag in fence:
                    break
        if tag == "body":
            cut(1)
        above = stack[-1]
        e = _Element(tag, above, *_is_other(tag, m[3], above.within or above.tag in ("article", "main")))
        above.parts.append(e)
        order.append(e)
        closed = m[3].endswith("/")
        if tag in RAW and not (closed and tag in ("svg", "math")):
            end = ENDS[tag].search(page, at)
            if end is None and tag not in ("script", "style", "title", "textarea"):
                continue  # never closed: it holds nothing
            at = end.start() if end else len(page)
        if tag not in VOID and not closed or tag in BLOCK and tag not in VOID:
            stack.append(e)
            open_tags[tag] += 1
    if at < len(page):
        stack[-1].parts.append(page[at:])
    return root, order


def _leave_out(order: list[_Element]) -> None:
    """Settle which of the elements named as other things go, parents first: not those that are wrapped around the article."""
    chars, links, heads = {}, {}, {}
    for e in reversed(order):
        hard = e.tag in NEVER
        inner = [p for p in e.parts if not isinstance(p, str)]
        chars[e] = 0 if hard else sum(len("".join(p.split())) for p in e.parts if isinstance(p, str)) + sum(chars[p] for p in inner)
        links[e] = chars[e] if e.tag == "a" else 0 if hard else sum(links[p] for p in inner)
        # an element around the article holds its heading, not named as something else on the way
        heads[e] = not hard and (e.tag in ("h1", "main", "article") and not e.other or any(heads[p] for p in inner))
    whole = max(1, chars[order[0]])
    for e in order:
        if e.other and e.tag not in NEVER:
            around = any(heads[p] for p in e.parts if not isinstance(p, str))
            e.other = not (e.tag == "form" and 2 * chars[e] >= whole or around and 2 * chars[e] >= whole)
        elif e.perhaps and not e.other:
            e.other = (10 * chars[e] < whole or 10 * links[e] >= 3 * chars[e]) and not any(heads[p] for p in e.parts if not isinstance(p, str))


def _measure(order: list[_Element]) -> None:
    """Characters, tags and links below each element, then densities and their sums."""
    for e in reversed(order):
        e.chars = e.tags = e.link_chars = e.link_tags = 0
        if e.other:
            continue
        for p in e.parts:
            if isinstance(p, str):
                e.chars += len("".join(p.split()))
            elif not p.other:
                e.chars += p.chars
                e.tags += p.tags + 1
                e.link_chars += p.link_chars
                e.link_tags += p.link_tags + (p.tag == "a")
        if e.tag == "a":
            e.link_chars = e.chars
    body = next((e for e in order if e.tag == "body"), order[0])
    share = body.link_chars / max(body.chars, 1)
    for e in order:
        if e.other or not e.chars:
            e.density = 0.0
            continue
        tags, links, link_tags = max(e.tags, 1), max(e.link_chars, 1), max(e.link_tags, 1)
        base = math.log(e.chars / max(e.chars - e.link_chars, 1) * e.link_chars + share * e.chars + math.e)
        odds = max(e.chars / links * tags / link_tags, 1.0)
        e.density = e.chars / tags * (math.log(odds) / math.log(base) if base > 1.0 else math.log(odds))
    for e in order:
        e.sum = sum(p.density for p in e.parts if not isinstance(p, str))


def _content(order: list[_Element]) -> set[int]:
    """Ids of the elements whose subtrees are the article."""
    body = next((e for e in order if e.tag == "body"), order[0])
    below = {id(body)}
    inside = [body]
    for e in order:
        if e.parent is not None and id(e.parent) in below and not e.other and e is not body:
            below.add(id(e))
            inside.append(e)
    heart = max(inside, key=lambda e: e.sum)
    if heart.sum == 0:
        return {id(body)}
    path = [heart]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    for e in path:
        if e.tag in ("article", "main"):
            return {id(e)}
    threshold = min(e.density for e in path)
    best: dict[int, _Element] = {}
    for e in reversed(inside):  # the largest sum in each subtree
        own = best.get(id(e), e)
        own = e if e.sum >= own.sum else own
        best[id(e)] = own
        if e.parent is not None and (id(e.parent) not in best or best[id(e.parent)].sum < own.sum):
            best[id(e.parent)] = own
    return {id(best[id(e)]) for e in inside if e.density >= threshold}


def main_text(page: str | None) -> str:
    """The article's blocks, joined by empty lines."""
    if not page:
        return ""
    root, order = parsed(page)
    _leave_out(order)
    _measure(order)
    chosen = _content(order)
    first = next((i for i, e in enumerate(order) if id(e) in chosen), 0)
    chosen |= {id(e) for e in order[:first] if e.tag == "h1"}
    whole = all(id(e) not in chosen for e in order if e.tag in ("article", "main"))
    blocks, words = [], []

    def end() -> None:
        if text := " ".join(entities.unescape("".join(words)).split()):
            blocks.append(text)
        words.clear()

    todo: list[tuple[object, bool]] = [(root, False)]
    while todo:
        part, on = todo.pop()
        if part is None:
            end()
        elif isinstance(part, str):
            if on:
                words.append(part)
        elif not part.other:
            on = on or id(part) in chosen
            if part.tag == "br":
                words.append(" ")
                continue
            block = part.tag in BLOCK
            if block:
                end()
                todo.append((None, False))
            todo.extend((p, on) for p in reversed(part.parts))
    end()
    while whole and len(blocks) > 1 and COPYRIGHT.fullmatch(blocks[-1]):
        blocks.pop()
    return "\n\n".join(blocks)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns but the html, with ``text`` and ``n_chars``."""
    others = [c for c in pages.columns if c != html]
    if clash := {"text", "n_chars"} & set(others):
        raise ValueError(f"columns of the input clash with results: {sorted(clash)}")
    rows = pages.select(*others, html)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(len(others))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*others, "text"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(read, f"{kinds}, text string").select("*", F.char_length("text").cast("long").alias("n_chars"))


@register("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
