"""Main text of web pages by tree scoring (operator 10).

A page's tags build a light tree.  Scripts, menus, headers, footers, asides,
dialogs and hidden parts are cut off by element and role.  Forms and elements
that look like sidebars, notices, adverts or reader comments by the words of
class and id are cut unless they hold most of the page's text, so a container of
the whole article stays whatever its class.  Of what is left, every paragraph earns points for
its length and commas, less its share of link text, and passes them to its
ancestors: all to the parent, half to the next, a shrinking part above.  A
container's points are discounted by its own link density; the best one and
those siblings that score near it, are paragraphs of running text or head it,
make the article.

Blocks are the runs of text between block elements (``br`` is white space);
character references are decoded, white space becomes single blanks, blocks are
joined by one ``\\n``.  Nothing is capped.

Any style was allowed; this is ``mapInArrow``, one page at a time, no shuffle
and no state between pages; memory is one Arrow batch and one page's tree.  Time is
linear in a page's length whatever its nesting and however broken its tags: open
elements are counted by tag, the ends of tags that never close are looked for
once, and points climb ``REACH`` levels, beyond which a paragraph would pass on less
than a hundredth.

Defined results: null or empty html gives an empty text; a page without tags is
one block; pages without scoring paragraphs give all that was not cut off;
unclosed and stray tags are repaired by the usual rules; repeated pages are
extracted each on their own; an empty table gives no rows; pages of any length are
read whole; other columns pass through by position, and a result column whose
name is there already (in any case) raises ValueError.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NAME_END = re.compile(r"[\s/>]")
QUOTE_OR_END = re.compile(r"[>\"']")
REACH = 40
ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# Element names of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CUT = frozenset(
    "script style noscript template textarea iframe object embed svg canvas math audio video map "
    "head title nav footer aside button select input label dialog menu search "
    "noembed noframes xmp".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog "
                      "menu menubar toolbar form status tooltip".split())
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay sidebar aside widget "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar footer "
    "masthead comment comments respond reply replies disqus share sharing social related "
    "recommended newsletter subscribe signup login search hidden skip".split())
KEEP = frozenset("html body article main".split())
# Words of content beside which a word above says nothing; elements that may wrap a whole page.
CONTENT_WORDS = frozenset("article body content entry hentry main page post story text".split())
DOUBTFUL = frozenset(["form", "fieldset"])
# Shares of the page's text outside links from which a doubtful element stays: one
# that holds a title, article or main element, and any other.
SHARE, BARE_SHARE = 0.4, 0.8
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPH = frozenset("p pre td blockquote li dd div section article figcaption".split())
# A start tag closes these open elements, up to one of the stops.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")),
          "th": (("td", "th"), ("table", "tr")), "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
          "option": (("option",), ("select",)), "body": (("head",), ("html",))}
CLOSES["thead"] = CLOSES["tfoot"] = CLOSES["tbody"]
P_STOPS = frozenset("html body article main section div td th li table blockquote button object "
                    "form fieldset header footer aside nav figure details dd".split())


RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


class Tree:
    """Elements in page order: tag, parent, cut flag, doubt; texts between them.

    ``doubt`` marks elements that look unwanted by class, id or as a form, which
    ``settle`` cuts or keeps by the text they hold.
    """

    def __init__(self):
        self.tag, self.parent, self.cut, self.doubt = ["#root"], [-1], [False], [False]
        self.proof = [False]           # article and main elements that are no comments or the like
        self.items: list = []          # (element, text) or (element, None) at a block edge

    def element(self, tag: str, parent: int, cut: bool, doubt: bool, proof: bool) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.cut.append(cut or self.cut[parent])
        self.doubt.append(doubt)
        self.proof.append(proof)
        return len(self.tag) - 1


def unwanted(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element and all below it are surely, or by its looks, no part of an
    article, and whether it is the element of an article."""
    if tag in CUT or tag == "header" and not in_article:
        return True, False, False
    doubt, seen, whole, content = tag in DOUBTFUL, False, False, False
    for m in ATTR.finditer(attrs):
        name = m.group(1).lower()
        value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if name == "role" and value.strip() in CUT_ROLES and tag not in KEEP:
            if value.strip() not in DOUBTFUL:
                return True, False, False
            doubt = True
        if name in ("class", "id"):
            words = value.split()
            seen = seen or not CUT_WORDS.isdisjoint(re.split(r"[^a-z0-9]+", value))
            whole = whole or not CUT_WORDS.isdisjoint(words)
            content = content or not CONTENT_WORDS.isdisjoint(words)
        if (name == "hidden" or name == "aria-hidden" and value == "true" or name == "style"
                and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return tag not in ("html", "body"), False, False
    if tag in KEEP:
        return False, False, tag in ("article", "main") and not seen
    # "post has-sidebar" is a post, "widget text" may be anything.
    return False, doubt or seen and (whole or not content), False


def settle(t: Tree) -> None:
    """Cuts doubtful elements, but those that hold most of the page's text outside links.

    Inner ones are judged first and what they lose counts for nothing further
    out.  If nothing at all would be left, the doubtful elements stay.
    """
    if True not in t.doubt:
        return
    n = len(t.tag)
    linked, size, lost, proof, some = [False] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for e in range(1, n):
        linked[e] = linked[t.parent[e]] or t.tag[e] == "a"
    for e, text in t.items:
        if text is not None and not t.cut[e]:
            length = len(text.strip())
            some[e] = some[e] or length > 0
            if not linked[e]:
                size[e] += length
    whole = sum(size)
    filled = size[:]
    for e in range(n - 1, 0, -1):
        filled[t.parent[e]] += filled[e]
    mark = [t.proof[e] and not t.cut[e] and filled[e] > 0 for e in range(n)]
    marks, stays = sum(mark), [True] * n
    titled = [t.tag[e] == "h1" and not t.cut[e] for e in range(n)]
    for e in range(n - 1, 0, -1):
        proof[e] += mark[e]
        if t.doubt[e]:
            share = size[e] / max(whole - lost[e], 1)
            stays[e] = (share >= SHARE if proof[e] or titled[e] else share >= BARE_SHARE and not marks)
        up = t.parent[e]
        lost[up] += lost[e]
        if stays[e]:
            size[up] += size[e]
            proof[up] += proof[e]
            titled[up] = titled[up] or titled[e]
        else:
            lost[up] += size[e]
    gone = [False] * n
    for e in range(1, n):
        gone[e] = gone[t.parent[e]] or not stays[e]
    if any(some[e] and not gone[e] for e in range(n)):
        t.cut = [a or b for a, b in zip(t.cut, gone)]


class Scanner:
    """Tags of a page from left to right, in time linear in its length.

    Searches remember what they found: the next quote or ``>``, the next end of a name,
    and from which quote on a tag has no end are the same for every ``<`` before them.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = html.rfind(">")
        self.name_end = self.special = -1
        self.ends: dict[int, int] = {}       # where a tag ends that is outside quotes here
        self.quotes = {q: html.rfind(q) for q in "\"'"}

    def _end(self, at: int) -> int:
        """The place after the ``>`` that closes a tag whose attributes start at ``at``, or -1."""
        html, path = self.html, []
        if self.special < at:
            self.special = self._special(at)
        s = self.special
        while s not in self.ends:
            path.append(s)
            if s == len(html):
                self.ends[s] = -1
            elif html[s] == ">":
                self.ends[s] = s + 1
            elif self.quotes[html[s]] == s:  # it is never closed
                self.ends[s] = -1
            else:
                s = self._special(html.find(html[s], s + 1) + 1)
        end = self.ends[s]
        for s in path:
            self.ends[s] = end
        return end

    def _special(self, at: int) -> int:
        m = QUOTE_OR_END.search(self.html, at)
        return m.start() if m else len(self.html)

    def tag(self, lt: int) -> tuple[int, str | None, str, bool] | None:
        """(end, name or None for a comment, attributes, is an end tag) of the tag at a ``<``."""
        html = self.html
        c = html[lt + 1:lt + 2]
        if c == "!" or c == "?":
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                return (end + 3 if end >= 0 else len(html)), None, "", False
            if lt > self.last:
                return None
            return html.find(">", lt) + 1, None, "", False
        start = lt + 2 if c == "/" else lt + 1
        c = html[start:start + 1]
        if lt > self.last or not (c.isascii() and c.isalpha()):
            return None
        if self.name_end <= start:
            m = NAME_END.search(html, start + 1)
            self.name_end = m.start() if m else len(html)
        stop = self.name_end
        end = self._end(stop)
        if end < 0:
            return None
        return end, html[start:stop].lower(), html[stop:end - 1], start == lt + 2


class Open:
    """The stack of open elements, with the places of each tag in it."""

    def __init__(self, t: Tree):
        self.t, self.stack = t, [0]
        self.at: dict[str, list[int]] = {}
        self.paragraphs: list[int] = []    # places of p and of what ends the search for one
        self.articles = 0

    def push(self, e: int) -> None:
        tag = self.t.tag[e]
        self.at.setdefault(tag, []).append(len(self.stack))
        if tag == "p" or tag in P_STOPS:
            self.paragraphs.append(len(self.stack))
        self.articles += tag in ("article", "main")
        self.stack.append(e)

    def close_to(self, k: int) -> None:
        t = self.t
        for e in self.stack[k:]:
            if t.tag[e] in BLOCK:
                t.items.append((t.parent[e], None))
                break
        while len(self.stack) > k:
            tag = t.tag[self.stack.pop()]
            self.at[tag].pop()
            if tag == "p" or tag in P_STOPS:
                self.paragraphs.pop()
            self.articles -= tag in ("article", "main")

    def end_paragraph(self) -> None:
        if self.paragraphs and self.t.tag[self.stack[self.paragraphs[-1]]] == "p":
            self.close_to(self.paragraphs[-1])

    def end_implied(self, name: str) -> None:
        """Close the outermost element that ``name`` ends, up to the nearest stop."""
        ends, stops = CLOSES[name]
        stop = max((self.at[x][-1] for x in stops if self.at.get(x)), default=0)
        found = [places[k] for places in (self.at.get(x) or () for x in ends)
                 if (k := bisect_right(places, stop)) < len(places)]
        if found:
            self.close_to(min(found))


def parse(html: str) -> Tree:
    t = Tree()
    items, scan, held = t.items, Scanner(html), Open(t)
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            items.append((held.stack[-1], html[at:lt]))
            at = lt
            continue
        m = scan.tag(at)
        if m is None:  # a bare "<" is text
            items.append((held.stack[-1], "<"))
            at += 1
            continue
        at, name, attrs, closes = m
        if name is None:
            continue
        if closes:
            if held.at.get(name):
                held.close_to(held.at[name][-1])
            elif name == "p":
                items.append((held.stack[-1], None))
            continue
        if name == "br":
            items.append((held.stack[-1], " "))
            continue
        if name in BLOCK:
            items.append((held.stack[-1], None))
            held.end_paragraph()  # a block ends an open paragraph
        if name in CLOSES:
            held.end_implied(name)
        e = t.element(name, held.stack[-1], *unwanted(name, attrs, held.articles > 0))
        if name in VOID or attrs.endswith("/") and name not in BLOCK and name not in RAW:
            continue
        if name in RAW:
            end = RAW_END[name].search(html, at) if at <= scan.last else None
            at = end.end() if end else n
            continue
        held.push(e)
    return t


def best_container(t: Tree) -> tuple[int, list[float]]:
    """The element whose paragraphs score best, and all elements' points."""
    size, links, commas = [0] * len(t.tag), [0] * len(t.tag), [0] * len(t.tag)
    own: dict[int, list] = {}
    near: list[int] = [-1] * len(t.tag)     # nearest paragraph-like element
    in_link = [False] * len(t.tag)
    for e in range(1, len(t.tag)):
        p = t.parent[e]
        near[e] = e if t.tag[e] in PARAGRAPH else near[p]
        in_link[e] = in_link[p] or t.tag[e] == "a"
    for e, text in t.items:
        if text is None or t.cut[e] or text.isspace():
            continue
        length = len(text.strip())
        size[e] += length
        if in_link[e]:
            links[e] += length
        if near[e] > 0:
            o = own.setdefault(near[e], [0, 0, 0])
            o[0] += length
            o[1] += text.count(",") + text.count("，") + text.count("、")
            o[2] += length if in_link[e] else 0
    for e in range(len(t.tag) - 1, 0, -1):
        size[t.parent[e]] += size[e]
        links[t.parent[e]] += links[e]
    points = [0.0] * len(t.tag)
    for e, (length, n_commas, linked) in own.items():
        gain = (1 + n_commas + min(length / 100, 3)) * (1 - linked / max(length, 1))
        # A paragraph's own block container counts it whole, those above less.
        up = e if t.tag[e] in ("div", "section", "article") else t.parent[e]
        level = 1
        while up > 0 and level <= REACH:
            points[up] += gain / (level if level < 3 else 3 * (level - 1))
            up = t.parent[up]
            level += 1
    for e in range(1, len(t.tag)):
        if t.tag[e] in ("article", "main") and not t.cut[e] and size[e]:
            points[e] += 25
        points[e] *= 1 - links[e] / max(size[e], 1)
    best = max(range(len(t.tag)), key=lambda e: (points[e], -e))
    return (best if points[best] > 0 else 0), points


def chosen(t: Tree) -> list[bool]:
    """Which elements belong to the article."""
    best, points = best_container(t)
    roots = {best}
    if best > 0 and t.tag[best] not in ("body", "html"):
        size: dict[int, int] = {}
        linked: dict[int, int] = {}
        family = [e for e in range(1, len(t.tag)) if t.parent[e] == t.parent[best] and not t.cut[e]]
        under = {e: e for e in family}
        in_link = {e: t.tag[e] == "a" for e in family}
        for e in range(1, len(t.tag)):
            if e not in under and t.parent[e] in under:
                under[e] = under[t.parent[e]]
                in_link[e] = in_link[t.parent[e]] or t.tag[e] == "a"
        for e, text in t.items:
            if text is not None and e in under:
                k = under[e]
                size[k] = size.get(k, 0) + len(text.strip())
                if in_link[e]:
                    linked[k] = linked.get(k, 0) + len(text.strip())
        for e in family:
            density = linked.get(e, 0) / max(size.get(e, 0), 1)
            if points[e] >= max(10, 0.2 * points[best]) or density < 0.25 and (
                    t.tag[e] == "p" and size.get(e, 0) > 80 or t.tag[e] == "h1"):
                roots.add(e)
    keep = [False] * len(t.tag)
    keep[0] = 0 in roots
    for e in range(1, len(t.tag)):
        keep[e] = (e in roots or keep[t.parent[e]]) and not t.cut[e]
    return keep


def main_text(html: str | None) -> str:
    """The article of one page as blocks joined by ``\\n``."""
    if not html:
        return ""
    t = parse(html)
    settle(t)
    keep = chosen(t)
    out, held = [], []
    for e, text in [*t.items, (0, None)]:
        if text is not None:
            if keep[e]:
                held.append(text)
            continue
        if held:
            block = "".join(held)
            held = []
            block = " ".join((unescape(block) if "&" in block else block).split())
            if block:
                out.append(block)
    return "\n".join(out)


def extract(df: DataFrame, html: str = "html", to: str = "main_text") -> DataFrame:
    """``df`` with its html column replaced by the main text, as column ``to``."""
    at = df.columns.index(html)
    if to.lower() in (c.lower() for k, c in enumerate(df.columns) if k != at):
        raise ValueError(f"column {to} exists")
    rest = [k for k in range(len(df.columns)) if k != at]
    schema = T.StructType([df.schema.fields[k] for k in rest] + [T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(h) for h in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], texts], names=schema.names)

    return df.mapInArrow(run, schema)
