"""Main text of web pages by scoring the element tree.

Every paragraph passes points for its length and commas to the elements above
it, less the higher they are; an element's points are discounted by the share
of its text that is link text. The article around the best element is kept with
those of its siblings that score like it; without one, the best element and what
stands beside it or the elements around it: headings, paragraphs, lists and tables,
and whatever else holds a paragraph, if little of it is link text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from simsearch.llm.texts import pieces

# Elements of HTML by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var ruby rb rt rp wbr img".split()
)
LEFT_OUT = frozenset(
    "head nav footer aside script style noscript template svg math canvas iframe object "
    "embed audio video select button textarea title dialog menu menuitem fieldset map".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul".split()
)
ENDS_ITEM = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class and id that name what is not the article, and words that may stand beside them.
NOT_ARTICLE = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promos "
    "promotion banner sidebar menu menus nav navbar navigation breadcrumb breadcrumbs header masthead "
    "footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "signup share sharing social related recommended widget toolbar pagination pager login searchbox "
    "legal copyright comment comments commentlist discussion disqus replies respond "
    "responses feedback".split()
)
PLAIN = frozenset(
    "area list wrapper wrap container box block inner outer item items site global links body reader readers "
    "user users".split()
)
COMMENTS = frozenset("comment comments commentlist discussion disqus replies respond responses feedback".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar "
    "toolbar".split()
)
WHOLE = frozenset(["article", "main"])
# What a comment has beside its text: words of class and id, elements and texts that date or sign it.
DATES = frozenset("date dated time timestamp ago published posted datetime".split())
AUTHORS = frozenset("author user username userlink commenter avatar byline vcard nick nickname poster fn".split())
NAME_TAGS = frozenset("b strong cite em a address".split())
DATE = re.compile(
    r"\b\d{4}-\d\d?-\d\d?\b|\b\d\d?[./]\d\d?[./]\d{2,4}\b|\b\d\d?:\d\d\b"
    r"|\b\d+ (?:second|minute|min|hour|day|week|month|year)s? ago\b"
    r"|\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.? \d\d?\b"
    r"|\b\d\d?\.? (?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", re.I,
)

TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<other>[!?][^>]*+>?)|(?P<close>/?)"
    r"(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[a-z]+")

PROSE = HEADINGS | frozenset("p ul ol li dl dt dd table pre blockquote figure".split())
LINKED = 1 / 3  # Share of link text beyond which an element beside the best one is a list of links.
PARAGRAPH = 25  # Characters from which on a block passes points.
# An element in doubt holds the article if it has more than such a share of the page's points: one whose
# whole name is another part of a page, and a form or one with such a word somewhere in its name.
NAMED, PARTLY, FORM = 1, 2, 3
MOST = {NAMED: 0.9, PARTLY: 1 / 3, FORM: 1 / 3}
LONG = 100  # Characters outside links from which on a block under a partly fitting name is kept.


class _Node:
    __slots__ = ("tag", "parent", "skip", "doubt", "comment", "kind", "dates", "signed", "level", "whole",
                 "points", "chars", "linked")

    def __init__(self, tag, parent, skip, doubt=0, comment=0, kind=""):
        self.tag, self.parent, self.skip, self.doubt = tag, parent, skip, doubt
        self.comment, self.kind, self.dates, self.signed = comment, kind, 0, False
        self.level = parent.level + 1 if parent else 0
        # The outermost article around the element, else the main part of the page.
        self.whole = parent and parent.whole
        if tag == "article" and (self.whole is None or self.whole.tag == "main") or tag == "main" and not self.whole:
            self.whole = self
        self.points = 0.0
        self.chars = self.linked = 0


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}


def _left_out(tag: str, found: dict[str, str], names: list[set[str]], in_article: bool) -> tuple[bool, int]:
    """Whether an element is left out with all it holds, and if not, what puts it in doubt."""
    if tag in LEFT_OUT or tag == "header" and not in_article:
        return True, 0
    form = FORM if tag == "form" else 0
    if not found or tag in ("html", "body"):
        return False, form
    role = found.get("role", "").lower()
    if "hidden" in found or found.get("aria-hidden") == "true" or role in ROLES:
        return True, 0
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True, 0
    careful = tag in WHOLE or tag in HEADINGS or tag == "header"
    listed = COMMENTS if careful else NOT_ARTICLE
    names = [n for n in names if n & listed]
    if any(n <= listed | PLAIN for n in names):
        return False, NAMED
    return False, form or (FORM if role == "form" else PARTLY if names and not careful else 0)


FULLY, SOMEHOW = 2, 1


def _comment(tag: str, names: list[set[str]]) -> int:
    """Whether a name is that of reader comments, or has such a word in it."""
    if tag in ("html", "body"):
        return 0
    names = [n for n in names if n & COMMENTS]
    return FULLY if any(n <= COMMENTS | PLAIN for n in names) else SOMEHOW if names else 0


def _blocks(page: str) -> list[tuple[_Node, list[tuple[_Node, str, bool]]]]:
    """Text blocks in page order: the element of each, and its texts with theirs and whether they are links."""
    root = _Node("html", None, False)
    stack, blocks, texts = [root], [], []
    opened = Counter()  # tags on the stack, so that a stray closing tag is told without a search
    in_link = False
    here = root

    def end_block():
        if any(not t.isspace() for _, t, _ in texts):
            node = here
            while node.tag in INLINE:
                node = node.parent
            blocks.append((node, texts.copy()))
            if sum(len(t) for _, t, _ in texts) <= LONG and DATE.search("".join([t for _, t, _ in texts])):
                node.dates += 1
        texts.clear()

    def pop(depth):
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def add(piece: str):
        if piece and not here.skip:
            texts.append((here, html.unescape(piece) if "&" in piece else piece, in_link))

    at, size = 0, len(page)
    while at < size:
        less = page.find("<", at)
        if less < 0:
            add(page[at:])
            break
        add(page[at:less])
        found = TAG.match(page, less)
        if not found:
            after = page[less + 1:less + 3].lstrip("/")[:1]
            if after.isalpha() and after.isascii():
                if (end := page.find(">", less)) < 0:
                    break  # the page ends inside a tag
                at = end + 1
            else:
                add("<")
                at = less + 1
            continue
        at = found.end()
        tag = found["name"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["close"]:
            if tag == "a":
                in_link = False
            if tag == "br":
                end_block()
            for depth in range(len(stack) - 1 if opened[tag] else 0, 0, -1):
                if stack[depth].tag == tag:
                    if any(n.tag not in INLINE for n in stack[depth:]):
                        end_block()
                        in_link = False
                    pop(depth)
                    here = stack[-1]
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if tag in ("br", "hr"):
            end_block()
            continue
        if tag in VOID:
            continue
        in_article = stack[-1].whole is not None
        rest = found["rest"]
        attributes = _attributes(rest) if rest and not rest.isspace() else {}
        label = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
        names = [set(WORDS.findall(n)) for n in label]
        skip, doubt = _left_out(tag, attributes, names, in_article)
        dated = tag == "time" or any(n & DATES for n in names)
        signed = attributes.get("rel") == "author" or any(n & AUTHORS for n in names)
        if tag in INLINE:
            if tag == "a":
                in_link = True
            here.dates += dated
            here.signed |= signed or tag in NAME_TAGS and not texts
            if not (skip or doubt == NAMED) or here.skip or here.doubt and here.tag in INLINE:
                continue
        else:
            end_block()
            in_link = False
            ends = ENDS_ITEM.get(tag, ())
            if tag in ENDS_PARAGRAPH:
                ends = {"p"} | HEADINGS if tag in HEADINGS else {"p"}
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    pop(depth)
                    break
                if stack[depth].tag not in INLINE and stack[depth].tag not in ("tbody", "thead", "tfoot"):
                    break
        kind = " ".join(sorted(WORDS.findall(attributes.get("class", "").lower())))
        here = _Node(tag, stack[-1], stack[-1].skip or skip, doubt, _comment(tag, names), kind)
        here.dates, here.signed = int(dated), signed or tag in NAME_TAGS
        stack.append(here)
        opened[tag] += 1
    end_block()
    return blocks


def _points(text: str, linked: int) -> float:
    return (1 + text.count(",") + min(3.0, len(text) / 100)) * (1.0 - min(1.0, linked / max(1, len(text))))


def _joined(texts: list[tuple[_Node, str, bool]]) -> tuple[str, int]:
    """A block's text and how much of it is link text."""
    return " ".join("".join([t for _, t, _ in texts]).split()), sum(len(t) for _, t, link in texts if link)


def _judged(blocks):
    """Blocks as element, text and length of link text, without the elements in doubt that don't hold the article."""
    order = _around(t[0] for _, texts in blocks for t in texts)
    blocks = _without(blocks, order, _named_comments(blocks, order))
    order = _around(t[0] for _, texts in blocks for t in texts)
    blocks = _without(blocks, order, _listed_comments(blocks, order))
    order = _around(t[0] for _, texts in blocks for t in texts)
    if any(node.doubt for node in order):
        blocks = _without(blocks, order, _dropped(blocks, order))
    found = [(node, *_joined(texts)) for node, texts in blocks]
    return [b for b in found if b[1]]


def _without(blocks, order: list[_Node], dropped: set[_Node]):
    """Blocks without the texts in any of the elements."""
    if not dropped:
        return blocks
    lost = {}
    for node in order:  # an element comes before those it holds
        lost[node] = node in dropped or node.parent is not None and lost[node.parent]
    found = [(node, [t for t in texts if not lost[t[0]]]) for node, texts in blocks]
    return [b for b in found if b[1]]


def _is_prose(node: _Node, texts, least: int = PARAGRAPH) -> bool:
    """Whether a block is a heading or a paragraph."""
    text, linked = _joined(texts)
    return bool(text) and (node.tag in HEADINGS or len(text) >= least and linked <= LINKED * len(text))


def _named_comments(blocks, order: list[_Node]) -> set[_Node]:
    """Elements named as reader comments, however much they hold, if something else can be the article.

    A name that says no more needs a heading or paragraph outside. One with other words
    in it needs a long paragraph there, and inside a list of like elements, but
    neither the title nor a marked article.
    """
    if not any(node.comment for node in order):
        return set()
    found = set()
    for comment, least in ((FULLY, PARAGRAPH), (SOMEHOW, LONG)):
        own = {n for n in order if n.comment == comment}
        if comment == SOMEHOW:
            own -= set(_around(n for n in order if n.tag == "h1" or n.tag in WHOLE))
            like = Counter((n.parent, n.tag, n.kind) for n in order if n.tag != "p" and n.tag not in INLINE)
            own &= {parent for (parent, _, _), many in like.items() if many > 2}
        inside = {}
        for node in order:
            inside[node] = node in own or node in found or node.parent is not None and inside[node.parent]
        outside = [(n, t) for n, t in blocks if not inside[n]]
        if own and any(_is_prose(n, t, least) and (comment == FULLY or n.tag not in HEADINGS) for n, t in outside):
            found |= own
    return found


def _listed_comments(blocks, order: list[_Node]) -> set[_Node]:
    """Lists of comments by their structure, below a heading or paragraph.

    Two or more elements of the same tag and class in one element, each with a date
    and a name and none with a title: their list goes too if it has little else.
    """
    dates = {n: n.dates for n in order}
    signed, titled = {n: n.signed for n in order}, {n: n.tag in ("h1", "h2") or n.tag in WHOLE for n in order}
    for node in reversed(order):
        if node.parent is not None:
            dates[node.parent] += dates[node]
            signed[node.parent] |= signed[node]
            titled[node.parent] |= titled[node]
    groups = {}
    for node in order:
        if node.parent is not None and node.tag not in INLINE and dates[node] and signed[node] and not titled[node]:
            groups.setdefault((node.parent, node.tag, node.kind), []).append(node)
    items = {n for some in groups.values() if len(some) > 1 for n in some}
    if not items:
        return set()
    inside, first = {}, None
    for node in order:
        inside[node] = node in items or node.parent is not None and inside[node.parent]
    for at, (node, _) in enumerate(blocks):
        if inside[node]:
            first = at
            break
    if first is None or not any(_is_prose(n, t) for n, t in blocks[:first]):
        return set()
    rest = {}
    for node, texts in blocks:
        while node is not None and not inside[node]:
            rest[node] = max(rest.get(node, 0), len(_joined(texts)[0]))
            node = node.parent
    lists = {n.parent for n in items if n.parent.tag not in ("html", "body") and not titled[n.parent]}
    return items | {n for n in lists if rest.get(n, 0) < LONG}


def _around(nodes: Iterable[_Node]) -> list[_Node]:
    """The elements and all around them, outer ones first."""
    found = {}
    for node in nodes:
        new = []
        while node is not None and node not in found:
            new.append(node)
            node = node.parent
        found.update(dict.fromkeys(reversed(new)))
    return list(found)


def _dropped(blocks, order: list[_Node]) -> set[_Node]:
    points, longest, title = dict.fromkeys(order, 0.0), dict.fromkeys(order, 0), set()
    for _, texts in blocks:
        own = {}
        for t in texts:
            own.setdefault(t[0], []).append(t)
        for node, some in own.items():
            text, linked = _joined(some)
            if len(text) >= PARAGRAPH:
                points[node] += _points(text, linked)
            longest[node] = max(longest[node], len(text) - linked)
            if node.tag == "h1":
                title.add(node)
    for node in reversed(order):
        if node.parent is not None:
            points[node.parent] += points[node]
            longest[node.parent] = max(longest[node.parent], longest[node])
            if node in title:
                title.add(node.parent)
    total = points[order[0]]
    # What holds the article or main part with the most points stays, unless its name fits and it has few.
    marked = [n for n in order if n.tag in WHOLE and n.doubt != NAMED]
    best = max(marked, key=points.get, default=None)
    rich = best is not None and points[best] >= total / 4
    holds = set()
    while best is not None:
        holds.add(best)
        best = best.parent
    return {
        n for n in order
        if n.doubt and points[n] <= MOST[n.doubt] * total
        and not (n in holds and (rich or n.doubt != NAMED))
        and (n.doubt == NAMED or n not in title and (n.doubt == FORM or longest[n] < LONG))
    }


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, one to a line; empty if there is none."""
    blocks = _judged(_blocks(page or ""))
    if not blocks:
        return ""
    order = _around(node for node, _, _ in blocks)
    number = {node: i for i, node in enumerate(order)}
    points, held = np.zeros(len(order)), np.zeros(len(order), bool)
    path, depth = np.zeros(max(n.level for n in order) + 1, np.int64), {}
    weights = 1.0 / np.arange(1, len(path) + 1)
    for node, text, linked in blocks:
        node.chars += len(text)
        node.linked += linked
        if len(text) < PARAGRAPH:
            continue
        above = node.parent if node.tag == "p" or node.tag in HEADINGS or node.tag == "li" else node
        least, levels = above, above.level + 1
        while least is not None and depth.get(least.level) is not least:  # the rest of the path is that of the last
            path[least.level], depth[least.level] = number[least], least
            least = least.parent
        points[path[:levels]] += _points(text, linked) * weights[levels - 1::-1]
        held[path[levels - 1]] = True
    for node in reversed(order):
        node.points = points[number[node]]
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            held[number[node.parent]] |= held[number[node]]
    holders = {node for node in order if held[number[node]]}

    def score(node: _Node) -> float:
        return node.points * (1 - node.linked / max(1, node.chars))

    best, seen = None, set()
    for node, _, _ in blocks:  # in page order, so that of equal scores the first counts
        above = node
        while above is not None and above not in seen:
            seen.add(above)
            if above in holders and (best is None or score(above) > score(best)):
                best = above
            above = above.parent
    if best is None:  # only short blocks: the article if one is marked, else the page
        best = next((b for b, _, _ in blocks if b.whole is not None), blocks[0][0])
        best = best.whole or order[0]
    if best.whole is None:
        return "\n".join(_with_siblings(best, blocks, order, holders))
    whole = best.whole
    least = max(10.0, score(whole) / 5)
    # Beside an article with a paragraph of its own only other articles belong to it.
    alone = any(b.whole is whole and len(text) - linked >= LONG for b, text, linked in blocks)
    kept = {whole} | {
        n for n in holders
        if n.parent is whole.parent and n.parent and score(n) >= least and (not alone or n.tag in WHOLE)
    }
    within = {}
    for node in order:
        within[node] = node in kept or node.parent is not None and within[node.parent]
    return "\n".join([text for node, text, _ in blocks if within[node]])


def _with_siblings(
    best: _Node, blocks: list[tuple[_Node, str, int]], order: list[_Node], holders: set[_Node]
) -> Iterator[str]:
    """Texts of an element, and of what belongs to it beside it and beside the elements around it."""
    around = set()
    above = best.parent
    while above is not None:
        around.add(above)
        above = above.parent
    kept = {}
    for node in order:
        if node is best or node.parent is None or node.parent in around:
            kept[node] = node is best or (
                node.linked <= LINKED * node.chars and (node.tag in PROSE or node in holders)
            )
        else:
            kept[node] = kept[node.parent]
    for node, text, linked in blocks:
        # Text of its own of an element around is judged by itself.
        if len(text) >= PARAGRAPH and linked <= LINKED * len(text) if node in around else kept[node]:
            yield text


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        columns = {n: batch.column(n) for n in batch.schema.names if n != "html"}
        yield pa.RecordBatch.from_pydict(columns | {
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        })


def extract_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns of every page, its main ``text`` and that text's code points, ``n_chars``.

    Only ``html`` is looked at, whole. A null or empty page, and one without
    text outside menus and the like, gives an empty text. Broken markup and
    pages cut off anywhere are read as far as they go. Each row stands alone,
    so repeated rows give repeated rows, an empty table none.
    """
    fields = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep]
    return pages.select(*keep, "html").mapInArrow(
        _extract, ", ".join([*fields, "text string, n_chars long"])
    )
