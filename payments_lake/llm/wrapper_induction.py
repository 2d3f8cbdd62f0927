"""Main texts of pages by wrappers that are learned from the pages of the same host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payments_lake.llm.common import text_or_empty, written
from payments_lake.llm.dom import TEXTUAL, Node, tree

# A text at a template's place belongs to the template if so many of the differing pages that have
# the place show it there.
SHARE = 0.9
LEAST_PAGES = 4
# Words that tell pages with different contents apart; copies with a few changes count once.
TELLING = 5
SALTS = 16
# Alignments kept by a task.
MOST_CACHED = 4096

# What pages call the parts that are no article.
BOILERPLATE_TAGS = frozenset("nav aside footer button select option optgroup menu dialog search fieldset legend input".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form status toolbar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion"
    " banner sidebar sidebars aside rail menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar"
    " header cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup"
    " login share sharing social related recommended trending widget widgets pagination pager toc skip comment comments"
    " commentlist respond replies reply disqus discussion form search copyright disclaimer paywall".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
ARTICLE_NAMES = frozenset("articlebody".split())
# A name with one of these in it speaks of its neighbours or of a setting.
ABOUT_OTHERS = frozenset("with has no without open closed enabled disabled".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@lru_cache(65536)
def names_of(value: str) -> tuple[tuple[str, ...], ...]:
    """The words of each name in a class or id: "siteFooter ad-slot" gives (site, footer), (ad, slot)."""
    return tuple(tuple(w.lower() for w in WORD.findall(name)) for name in value.split())


def called(attributes: dict[str, str], words: frozenset[str]) -> bool:
    """True if a class or id begins or ends with one of the words."""
    for key in ("class", "id"):
        if value := attributes.get(key):
            for name in names_of(value[:1000]):
                if name and (name[0] in words or name[-1] in words) and not ABOUT_OTHERS.intersection(name):
                    return True
    return False


def hidden(attributes: dict[str, str]) -> bool:
    return (
        "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
        or "display:none" in attributes.get("style", "").replace(" ", "").lower()
    )


def marked(tag: str, attributes: dict[str, str]) -> bool:
    """True for an element that says itself that it isn't part of an article."""
    return bool(attributes) and (
        attributes.get("role", "").lower() in BOILERPLATE_ROLES or hidden(attributes) or called(attributes, BOILERPLATE_NAMES)
    )


def is_article(node: Node) -> bool:
    role = node.attributes.get("role", "").lower()
    return (
        node.tag == "article" or role == "article" or node.attributes.get("itemprop", "").lower() in ARTICLE_NAMES
    ) and not called(node.attributes, COMMENT_NAMES) and not hidden(node.attributes)


def is_main(node: Node) -> bool:
    return node.tag == "main" or node.attributes.get("role", "").lower() == "main"


def holds(node: Node, test) -> bool:
    return any(test(c) or holds(c, test) for c in node.children if c.tag != "#")


def boilerplate(node: Node, within: bool) -> bool:
    """True for a subtree without article text. ``within``: it lies in an article or main part."""
    if node.tag in BOILERPLATE_TAGS:
        return True
    if is_article(node) or is_main(node):
        return False
    if node.tag == "header":
        return not within and not holds(node, is_article)
    if node.tag == "form" or marked(node.tag, node.attributes):
        # A form or a layout class may span the page.
        return not holds(node, lambda n: is_article(n) or is_main(n) or n.tag == "h1")
    return False


# ---------------------------------------------------------------- shapes and their alignment

class Shape:
    """A page's tree as the wrapper sees it: labels, with runs of equal siblings as one node.

    Leaves "#" are slots, numbered in order; ``slots[i]`` has the texts that slot i shows.
    """

    __slots__ = ("text", "slots")

    def __init__(self, root: Node) -> None:
        self.slots: list[list[Node]] = []
        label, body = self._shape(root)
        self.text = label + body[0]
        self._number(body[1])

    @staticmethod
    def _label(node: Node) -> str:
        names = {"-".join(w) for key in ("class", "id") for w in names_of(node.attributes.get(key, "")[:1000]) if w}
        return "".join([re.sub(r"[^a-z0-9-]", "", node.tag), *(f".{n}" for n in sorted(names))])

    def _shape(self, node: Node) -> tuple[str, tuple[str, list]]:
        """The node's label, and its children as text and as nested lists of texts by slot."""
        runs: list[list] = []
        for child in node.children:
            if child.tag == "#":
                text, parts = "#", [child]
            elif child.tag in TEXTUAL and not child.attributes and all(c.tag == "#" for c in child.children):
                if not child.children:
                    continue
                text, parts = "#", list(child.children)
            else:
                label, (body, parts) = self._shape(child)
                text = label + body
            if runs and runs[-1][0] == text:
                _merge(text, runs[-1][1], parts)
            else:
                runs.append([text, parts])
        return self._label(node), (f"({' '.join(r[0] for r in runs)})", runs)

    def _number(self, runs: list) -> None:
        for text, parts in runs:
            if text == "#":
                self.slots.append(parts)
            else:
                self._number(parts)


def _merge(text: str, first: list, second: list) -> None:
    """Adds the texts of a sibling of the same shape to the first one's, slot by slot."""
    if text == "#":
        first.extend(second)
        return
    for one, other in zip(first, second, strict=True):
        _merge(one[0], one[1], other[1])


def read_shape(text: str) -> tuple[str, list]:
    """(label, children) of a shape's text."""
    root: tuple[str, list] = ("", [])
    stack = [root]
    for label, mark in re.findall(r"([^() ]*)([() ]|$)", text):
        if mark == "(":
            node = (label, [])
            stack[-1][1].append(node)
            stack.append(node)
        else:
            if label:
                stack[-1][1].append((label, []))
            if mark == ")" and len(stack) > 1:
                stack.pop()
    return root[1][0]


class TreeMatch:
    """Simple tree matching: the largest matching of two ordered trees that keeps labels, parents
    and the order of siblings. ``slots[i]`` is the second tree's slot that slot i falls on, or -1."""

    def __init__(self, first: tuple[str, list], second: tuple[str, list]) -> None:
        self.scores: dict[tuple[int, int], int] = {}
        self.places = {id(leaf): i for side in (first, second) for i, leaf in enumerate(_leaves(side))}
        self.slots = [-1] * sum(1 for _ in _leaves(first))
        if first[0] == second[0]:
            self._align(first, second)

    def score(self, a: tuple[str, list], b: tuple[str, list]) -> int:
        if a[0] != b[0]:
            return 0
        if not a[1] or not b[1]:
            return 1
        key = (id(a), id(b))
        if key not in self.scores:
            self.scores[key] = 1 + self._row(a[1], b[1])[-1]
        return self.scores[key]

    def _row(self, a: list, b: list) -> list[int]:
        """Best scores of all of ``a`` with each beginning of ``b``."""
        row = [0] * (len(b) + 1)
        for x in a:
            corner = 0
            for j, y in enumerate(b):
                above = row[j + 1]
                best = max(above, row[j])
                if x[0] == y[0]:
                    best = max(best, corner + self.score(x, y))
                row[j + 1], corner = best, above
        return row

    def _align(self, a: tuple[str, list], b: tuple[str, list]) -> None:
        if a[0] == "#":
            self.slots[self.places[id(a)]] = self.places[id(b)]
            return
        pairs: list[tuple] = []
        self._pairs(a[1], b[1], pairs)
        for x, y in pairs:
            self._align(x, y)

    def _pairs(self, a: list, b: list, into: list[tuple]) -> None:
        """The matched siblings, by halves, so that a row of scores is all the memory it takes."""
        if not a or not b:
            return
        if len(a) == 1:
            best = max(range(len(b)), key=lambda j: (self.score(a[0], b[j]), -j))
            if self.score(a[0], b[best]):
                into.append((a[0], b[best]))
            return
        half = len(a) // 2
        left = self._row(a[:half], b)
        right = self._row(a[half:][::-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: (left[j] + right[len(b) - j], -j))
        self._pairs(a[:half], b[:cut], into)
        self._pairs(a[half:], b[cut:], into)


def _leaves(node: tuple[str, list]) -> Iterator[tuple]:
    if node[0] == "#":
        yield node
    for child in node[1]:
        yield from _leaves(child)


class Aligner(dict):
    """Slots of a shape on those of a host's template; forgets all once it holds many."""

    def __missing__(self, key: tuple[str, str]) -> list[int]:
        shape, template = key
        if shape == template:
            found = list(range(template.count("#")))
        else:
            found = TreeMatch(read_shape(shape), read_shape(template)).slots
        if len(self) >= MOST_CACHED:
            self.clear()
        self[key] = found
        return found


def digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


# ---------------------------------------------------------------- pages, templates, texts

def host_of(url: Column) -> Column:
    """The lower-cased host of a URL, without user and port; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@\s]+)", 1))
    return F.when(host != "", host)


def page_shape(html: str) -> tuple[Node, str, Shape]:
    root, title = tree(html, marked)
    return root, title, Shape(root)


def identity(title: str, slots: list[list[Node]]) -> int:
    """What tells a page from pages with another content: the first words of its title and of its
    longest block. Copies with a few changes mostly share them."""
    longest = max((n.text for slot in slots for n in slot), key=len, default="")
    begins = [" ".join(t.split(None, TELLING)[:TELLING]).lower() for t in (title, longest)]
    return digest("\n".join(begins))


def outlines(pages: DataFrame) -> DataFrame:
    """(host, page, shape, slots) of the pages with a host and text: what shows where."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("slot", pa.int32()), ("digest", pa.int64())]))
        for batch in batches:
            hosts, keys, shapes, shown = [], [], [], []
            for host, html in zip(batch.column("host"), batch.column("html"), strict=True):
                _, title, shape = page_shape(html.as_py())
                if shape.slots:
                    hosts.append(host.as_py())
                    keys.append(identity(title, shape.slots))
                    shapes.append(shape.text)
                    shown.append([
                        {"slot": i, "digest": d}
                        for i, slot in enumerate(shape.slots) for d in sorted({digest(n.text) for n in slot})
                    ])
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(shapes, pa.string()), pa.array(shown, kind)],
                ["host", "page", "shape", "slots"],
            )

    return pages.filter("host is not null").select("host", "html").mapInArrow(
        run, "host string, page bigint, shape string, slots array<struct<slot: int, digest: bigint>>"
    )


def salted(frame: DataFrame) -> DataFrame:
    return frame.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def wrappers(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, template, constants): per host the shape of most of its differing pages, and the
    (place, digest) of the texts that are constant there.

    All pages count. Each page's shape is aligned with its host's template by simple tree
    matching; a text is constant at a place if ``share`` of the differing pages that have the
    place show it there, and at least ``least_pages`` differing pages have it. Hosts may hold any
    share of the pages: what is counted first has the page in its key, joins are salted.
    """
    outlined = written(outlines(pages), "outlines")
    seen = outlined.select("host", "shape", "page").distinct().groupBy("host", "shape").agg(F.count("*").alias("pages"))
    order = F.struct("pages", -F.length("shape"), F.xxhash64("shape"), "shape")
    templates = written(seen.groupBy("host").agg(F.max(order)["shape"].alias("template")), "templates")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = Aligner()
        for batch in batches:
            hosts, pages_, places, digests = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("host", "page", "shape", "template", "slots"))
            for host, page, shape, template, slots in zip(*columns, strict=True):
                on = aligned[shape, template]
                found = {(on[one["slot"]], one["digest"]) for one in slots if on[one["slot"]] >= 0}
                # A line without a digest says that the page has the place.
                found |= {(place, None) for place, _ in found}
                hosts += [host] * len(found)
                pages_ += [page] * len(found)
                places += [place for place, _ in found]
                digests += [text for _, text in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(pages_, pa.int64()), pa.array(places, pa.int32()), pa.array(digests, pa.int64())],
                ["host", "page", "place", "digest"],
            )

    salt = F.pmod(F.xxhash64("page", "shape"), F.lit(SALTS)).cast("int")
    shown = (
        outlined.withColumn("salt", salt).join(salted(templates), ["host", "salt"])
        .select("host", "page", "shape", "template", "slots")
        .mapInArrow(place, "host string, page bigint, place int, digest bigint")
    )
    counts = written(
        shown.distinct().groupBy("host", "place", "digest").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= least_pages),
        "counts",
    )
    having = counts.filter("digest is null").select("host", "place", F.col("n").alias("pages"))
    constant = counts.filter("digest is not null").join(having, ["host", "place"]).filter(F.col("n") >= share * F.col("pages"))
    listed = constant.groupBy("host").agg(F.collect_list(F.struct("place", "digest")).alias("constants"))
    return written(templates.join(listed, "host"), "wrappers")


def content(root: Node, skip: frozenset[int]) -> list[str]:
    """The texts of the varying slots that belong to an article, in page order. ``skip`` has the
    ids of the constant ones."""

    def collect(node: Node, within: bool, into: list[str]) -> None:
        for child in node.children:
            if child.tag == "#":
                if id(child) not in skip:
                    into.append(child.text)
            elif not boilerplate(child, within):
                collect(child, within or is_article(child) or is_main(child), into)

    def tops(node: Node, test, into: list[Node]) -> None:
        for child in node.children:
            if child.tag == "#" or boilerplate(child, False):
                continue
            if test(child):
                into.append(child)
            else:
                tops(child, test, into)

    for test in (is_article, is_main):
        roots: list[Node] = []
        tops(root, test, roots)
        texts: list[str] = []
        for top in roots:
            collect(top, True, texts)
        if texts:
            return texts
    texts = []
    collect(root, False, texts)
    return texts


def main_text(html: str, template: str | None, constants: frozenset[tuple[int, int]], aligned: Aligner) -> str:
    root, _, shape = page_shape(html)
    skip = frozenset()
    if template is not None and constants:
        on = aligned[shape.text, template]
        skip = frozenset(
            id(n) for i, slot in enumerate(shape.slots) if on[i] >= 0 for n in slot if (on[i], digest(n.text)) in constants
        )
    return " ".join(content(root, skip))


def main_texts(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    The pages of a host are aligned as DOM trees; what stays constant at a place is template, what
    varies is content if no element around it says that it is a menu, header, footer, sidebar,
    notice, advert, form or comment. Where a page has an article (else a main part), only what
    lies in it counts. Hosts with fewer than ``least_pages`` differing pages, and pages without a
    host, have no template; their elements alone decide. White space is what Python splits at.

    A null or empty html gives an empty text; whole pages of any length are read, in time linear
    in their length; repeated rows give a row each and count once for the template; an empty table
    gives no rows; other columns are ignored.
    """
    named = pages.select(
        "page_id", "url", text_or_empty("html").alias("html"), host_of(F.col("url").cast("string")).alias("host")
    )
    known = salted(wrappers(named, share, least_pages))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    joined = named.withColumn("salt", salt).join(known, ["host", "salt"], "left").select(
        "page_id", "url", "html", "template", "constants"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = Aligner()
        for batch in batches:
            texts = []
            columns = (batch.column(c) for c in ("html", "template", "constants"))
            for html, template, constants in zip(*columns, strict=True):
                pairs = frozenset((c["place"], c["digest"]) for c in constants.as_py() or ())
                texts.append(main_text(html.as_py(), template.as_py(), pairs, aligned))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(named.dtypes)
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
