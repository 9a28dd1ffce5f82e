"""HTML extraction (3): wrappers inferred as union-free regular expressions from pages of one host.

A page becomes a balanced stream of tags and texts (inline markup vanishes into the text). Within a
page, repeated siblings fold into repeated groups; then the streams of a host are aligned one after
the other. Where they differ, the mismatch is resolved: a part that one side lacks becomes optional,
a part that occurs once here and again there becomes repeated, differing texts become a slot. The
result, the host's wrapper, is a union-free expression: a sequence of tags with nested sequences,
each optional and/or repeated, constants and text slots. Which slots hold the article is decided
once per wrapper, from regions, link shares and text mass over all its pages; a page's text is what
its own stream has in those slots, but for constants: lines that ``CONSTANT_PAGES`` pages or more of a host have
in the same slot, and all of them that have the slot, are the site's own. Headings stay, and a page all of constants keeps them.

Elements nested deeper than ``DEPTH`` are laid into the one at that depth, as browsers do, so that no page is
too deep to be walked.

Every task aligns its own pages first, so a host with a third of all pages is one small wrapper per
task afterwards; these meet in two rounds, salted by task.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsieve.llm.common import runs, ship_code
from shopsieve.sinks.scratch import hand_off

SALTS = 32
#: Longest unit of tags that is sought as a repeated group.
UNIT = 4
#: Levels of nested elements that are kept apart.
DEPTH = 100
#: A text that so many pages of a host, and no page without it, have in a slot is the site's own.
CONSTANT_PAGES = 8
#: Sequences with more pairs than this are aligned step by step instead of by longest common subsequence.
PAIRS, NEAR = 1_000_000, 64

# Kinds of HTML elements, and words in class or id that name a region.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe".split())  # text up to the literal end tag
HIDDEN = frozenset("svg template annotation annotation-xml".split())  # parts of their own, which may nest
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
    + "noscript object math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle".split()
    + "msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CLOSED_BY = {  # an open element of the key ends where one of these begins
    "p": frozenset(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
    "head": frozenset(["body"]),
}
ASIDE_TAGS = frozenset("head nav footer aside form button select dialog menu".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer login menu modal nav navbar "
    "navigation newsletter notice notices pagination popup promo promoted related replies reply responses search share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
MAIN_WORDS = frozenset("article content entry main post story".split())
# Words that make a name speak of a page's state instead of a region, at its beginning or end.
STATE_FIRST = frozenset("has hide is js no show with without".split())
STATE_LAST = frozenset("active allowed closed disabled enabled layout off on open page ready supported template visible".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Attributes are names with quoted or unquoted values; a quote elsewhere begins nothing.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>?|<\?[^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"?|'[^']*+'?|[^\s>\"'][^\s>]*+)?)*+)(?:>|\Z)|<[^A-Za-z/!?<][^<]*|</?[^<]*|[^<]+",
    re.DOTALL,
)
ENDS = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for tag in RAW | HIDDEN}
NAMED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


class Node:
    """A tag, a text ("#") or a group of tags ("(...)") of a stream or wrapper."""

    __slots__ = ("label", "children", "optional", "repeated", "constant", "chars", "linked", "keep", "text", "parts", "pages", "common", "spared")

    def __init__(self, label: str) -> None:
        self.label = label
        self.children: list[Node] = []
        self.optional = self.repeated = self.keep = False
        self.constant: int | None = None
        self.chars = self.linked = 0
        self.text = ""
        self.parts: list[list[Node]] = []
        self.pages = 1
        self.common: frozenset[int] = frozenset()  # texts of a slot that all its pages have
        self.spared: frozenset[str] = frozenset()  # of a root: names like side regions that hold the article

    def pack(self) -> list:
        flags = self.optional + 2 * self.repeated + 4 * self.keep
        return [self.label, flags, self.constant, self.chars, self.linked, [c.pack() for c in self.children], self.pages, sorted(self.common)]

    @classmethod
    def unpack(cls, packed: list) -> Node:
        node = cls(packed[0])
        node.optional, node.repeated, node.keep = (bool(packed[1] & b) for b in (1, 2, 4))
        node.constant, node.chars, node.linked = packed[2:5]
        node.children = [cls.unpack(c) for c in packed[5]]
        node.pages, node.common = packed[6], frozenset(packed[7])
        return node

    def expression(self) -> str:
        """The wrapper as a regular expression, for people."""
        inside = " ".join(c.expression() for c in self.children)
        if self.label == "#":
            own = "#" if self.constant is None else "text"
        elif self.label.startswith("("):
            own = f"({inside})"
        else:
            own = f"<{self.label}>{' ' * bool(inside)}{inside} </>"
        mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[self.optional, self.repeated]
        return f"({own}){mark}" if mark else own


def _label(tag: str, attributes: str) -> str:
    """The tag and its names, each as words with hyphens; digits, which tell pages apart, are left out."""
    names = set()
    if "=" in attributes:
        for given in " ".join(a or b or c for a, b, c in NAMED.findall(attributes)).split():
            names.add("-".join(re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1-\2", given).lower())))
    return ".".join([tag, *sorted(names - {""})])


def _past(page: str, tag: str, at: int) -> int:
    """Where the page goes on after the raw or hidden element that opened before ``at``.

    As in browsers, a raw element without its end tag is the rest of the page; a hidden one is passed over.
    """
    depth = 1
    for found in ENDS[tag].finditer(page, at):
        if found.group(1):
            depth -= 1
        elif tag in HIDDEN and not found.group().endswith("/>"):
            depth += 1
        if not depth:
            return found.end()
    return at if tag in HIDDEN else len(page)


def parse(page: str) -> Node:
    """The page as a tree: missing end tags are supplied, inline tags dropped, texts decoded and trimmed."""
    root = Node("")
    # tag, node that takes its texts, and whether it is a side region below the depth at which nodes end
    stack: list[tuple[str, Node, bool]] = [("", root, False)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked = links = at = 0

    def flush() -> None:
        nonlocal linked
        whole = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if whole and not stack[-1][2]:
            node = Node("#")
            node.text, node.chars, node.linked, node.constant = whole, len(whole), min(linked, len(whole)), crc32(whole.encode("utf-8", "replace"))
            node.common = frozenset([node.constant])
            stack[-1][1].children.append(node)
        linked = 0

    while at < len(page):
        for found in TOKEN.finditer(page, at):
            at = found.end()
            end, tag, attributes = found.groups()
            if tag is None:
                part = found.group()
                if not part.startswith(("<!", "<?", "</")):
                    text.append(part)
                    linked += len(part) * bool(links)
                continue
            tag = tag.lower()
            if tag in INLINE:
                links = max(0, links + (-1 if end else 1)) if tag == "a" else links
            elif tag in VOID:
                if tag == "hr":
                    flush()
                else:
                    text.append(" ")
            elif tag in ENDS:
                text.append(" ")
                if not end and not attributes.endswith("/"):
                    at = _past(page, tag, at)
                    break  # the search goes on from there
            elif end:
                flush()
                while opened[tag]:
                    closed = stack.pop()[0]
                    opened[closed] -= 1
                    if closed == tag:
                        break
                links = 0
            else:
                flush()
                links = 0
                while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1][0], ()):
                    opened[stack.pop()[0]] -= 1
                label = _label(tag, attributes)
                if len(stack) <= DEPTH:
                    node = Node(label)
                    stack[-1][1].children.append(node)
                    stack.append((tag, node, False))
                else:
                    stack.append((tag, stack[-1][1], stack[-1][2] or _aside(label)))
                opened[tag] += 1
    flush()
    return root


def merged(a: Node, b: Node, across: bool = True) -> Node:
    """The least expression of this kind that matches what either matches.

    ``across``: of two pages, whose slots have in common what both have; else of two parts of one page.
    """
    out = Node(a.label)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    out.constant = a.constant if a.constant == b.constant else None
    out.chars, out.linked = a.chars + b.chars, a.linked + b.linked
    out.pages = a.pages + b.pages if across else max(a.pages, b.pages)
    out.common = a.common & b.common if across else a.common | b.common
    out.children = align(a.children, b.children, across) if a.children or b.children else []
    return out


def fold(nodes: list[Node]) -> list[Node]:
    """Siblings with equal tags in a row become one repeated part, rows of units a repeated group.

    ``parts`` of a folded node lists the page's own nodes that it stands for.
    """
    out: list[Node] = []
    for node in nodes:
        shape = Node(node.label)
        shape.constant, shape.chars, shape.linked, shape.text, shape.common = node.constant, node.chars, node.linked, node.text, node.common
        shape.children = fold(node.children)
        shape.parts = [[node]]
        if out and out[-1].label == node.label:
            both = merged(out[-1], shape, across=False)
            both.repeated, both.parts = True, out[-1].parts + shape.parts
            out[-1] = both
        else:
            out.append(shape)
    for size in range(2, UNIT + 1):
        at = 0
        while at + 2 * size <= len(out):
            labels = [n.label for n in out[at : at + size]]
            units = 1
            while [n.label for n in out[at + units * size : at + (units + 1) * size]] == labels:
                units += 1
            if units > 1:
                out[at : at + units * size] = [_group([out[at + u * size : at + (u + 1) * size] for u in range(units)], True)]
            at += 1
    return out


def _group(units: list[list[Node]], repeated: bool) -> Node:
    group = Node(f"({'|'.join(n.label for n in units[0])})")
    group.repeated = repeated
    group.children = units[0]
    for unit in units[1:]:
        group.children = [merged(a, b, across=False) for a, b in zip(group.children, unit, strict=True)]
    group.parts = [[p for n in unit for part in n.parts for p in part] for unit in units]
    return group


def absorb(nodes: list[Node], groups: list[Node]) -> list[Node]:
    """Single occurrences of units that are repeated groups on the other side become groups too."""
    own = {n.label for n in nodes}
    for group in groups:
        if not group.label.startswith("(") or group.label in own:
            continue
        unit, at = [c.label for c in group.children], 0
        while at + len(unit) <= len(nodes):
            if [n.label for n in nodes[at : at + len(unit)]] == unit:
                nodes = [*nodes[:at], _group([nodes[at : at + len(unit)]], False), *nodes[at + len(unit) :]]
            at += 1
    return nodes


def matches(xs: list[Node], ys: list[Node]) -> list[tuple[int | None, int | None]]:
    """Longest common subsequence by label; unmatched places stand alone, in order.

    Equal beginnings and ends match as they are. What lies between is aligned step by step if it is very
    long, each label with the next like it that is near; so time and memory are bounded for any page.
    """
    a, b = [n.label for n in xs], [n.label for n in ys]
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    inner_a, inner_b = a[first : len(a) - last], b[first : len(b) - last]
    pairs = _subsequence(inner_a, inner_b) if len(inner_a) * len(inner_b) <= PAIRS else _step_by_step(inner_a, inner_b)
    matched = [(k, k) for k in range(first)] + [(i + first, j + first) for i, j in pairs]
    matched += [(len(a) - k, len(b) - k) for k in range(last, 0, -1)]
    out, i, j = [], 0, 0
    for to_i, to_j in [*matched, (len(a), len(b))]:
        out += [(k, None) for k in range(i, to_i)] + [(None, k) for k in range(j, to_j)]
        if to_i < len(a) and to_j < len(b):
            out.append((to_i, to_j))
        i, j = to_i + 1, to_j + 1
    return out


def _subsequence(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _step_by_step(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    where: dict[str, list[int]] = {}
    for j, label in enumerate(b):
        where.setdefault(label, []).append(j)
    out, j = [], 0
    for i, label in enumerate(a):
        places = where.get(label, [])
        at = bisect_left(places, j)
        if at < len(places) and places[at] < j + NEAR:
            out.append((i, places[at]))
            j = places[at] + 1
    return out


def align(xs: list[Node], ys: list[Node], across: bool = True) -> list[Node]:
    """Two sequences as one; what either side lacks is optional."""
    xs, ys = absorb(xs, ys), absorb(ys, xs)
    out = []
    for i, j in matches(xs, ys):
        if i is not None and j is not None:
            out.append(merged(xs[i], ys[j], across))
        else:
            node = xs[i] if j is None else ys[j]
            if not node.optional:
                alone = Node(node.label)
                alone.repeated, alone.constant, alone.chars, alone.linked, alone.children = node.repeated, node.constant, node.chars, node.linked, node.children
                alone.pages, alone.common = node.pages, node.common
                alone.optional = True
                node = alone
            out.append(node)
    return out


@lru_cache(maxsize=1 << 16)
def _side_name(label: str) -> bool:
    """Whether a name is that of a side region; one that says how the page is made, like has-sidebar, is not."""
    tag, *names = label.split(".")
    if tag in ("html", "body"):
        return False
    for words in (name.split("-") for name in names):
        if not ASIDE_WORDS.isdisjoint(words) and words[0] not in STATE_FIRST and (len(words) == 1 or words[-1] not in STATE_LAST):
            return True
    return False


def _words(label: str) -> set[str]:
    return {word for name in label.split(".")[1:] for word in name.split("-")}


def _aside(label: str, spared: frozenset[str] = frozenset()) -> bool:
    if label.startswith("("):  # a group; its members are judged one by one
        return False
    return label.split(".", 1)[0] in ASIDE_TAGS or label not in spared and _side_name(label)


def _mass(node: Node, spared: frozenset[str]) -> int:
    """Characters of texts that are neither links nor in a side region."""
    if node.label == "#":
        return node.chars - node.linked
    return 0 if _aside(node.label, spared) else sum(_mass(c, spared) for c in node.children)


def _article_like(label: str) -> bool:
    """Elements that can only be an article's by their tag or name, whatever stands around them."""
    if label.startswith("("):
        return False
    tag = label.split(".", 1)[0]
    return (tag in ("article", "main") and not _words(label) & {"comment", "comments", "reply", "replies"}) or (
        not MAIN_WORDS.isdisjoint(_words(label)) and not _side_name(label)
    )


def _spared(root: Node) -> frozenset[str]:
    """Labels like those of side regions on the way to the article, which is no side region itself.

    The article is the heaviest element of its kind, if it has a fifth of the page's text or more; ``sidebar``
    in the class of something around it then speaks of the layout.
    """
    masses: dict[int, int] = {}

    def weigh(node: Node) -> int:
        """Without regard to names."""
        if node.label == "#":
            return node.chars - node.linked
        tag = "" if node.label.startswith("(") else node.label.split(".", 1)[0]
        masses[id(node)] = 0 if tag in ASIDE_TAGS else sum(map(weigh, node.children))
        return masses[id(node)]

    total = weigh(root)
    best: tuple[int, frozenset[str]] = (0, frozenset())

    def walk(node: Node, above: frozenset[str]) -> None:
        nonlocal best
        if node.label == "#" or not masses[id(node)]:
            return
        if _side_name(node.label):
            above = above | {node.label}
        # outside of regions with such names an article counts in full
        weight = masses[id(node)] if above else 2 * masses[id(node)]
        if _article_like(node.label) and weight > best[0] and 5 * masses[id(node)] >= total:
            best = (weight, above)
        for child in node.children:
            walk(child, above)

    walk(root, frozenset())
    return best[1]


def _container(root: Node) -> Node:
    """Where the article is: by tag, else by name, else the deepest part with most of the text."""
    spared = root.spared

    def within(node: Node, wanted: Callable[[str], bool]) -> list[Node]:
        if _aside(node.label, spared):
            return []
        inner = [x for c in node.children for x in within(c, wanted)]
        return [node, *inner] if wanted(node.label) and not node.label.startswith("(") else inner

    for wanted in (
        lambda label: label.split(".")[0] == "article",
        lambda label: label.split(".")[0] == "main" or "main" in _words(label),
        lambda label: not MAIN_WORDS.isdisjoint(_words(label)),
    ):
        found = [n for n in within(root, wanted) if _mass(n, spared)]
        if found:
            return max(found, key=lambda n: _mass(n, spared))
    node = root
    while node.children:
        heavy = max(node.children, key=lambda n: _mass(n, spared))
        mass = _mass(heavy, spared)
        if heavy.label == "#" or 2 * mass < _mass(node, spared) or heavy.repeated or mass == 0:
            break
        if not any(c.label != "#" and not _aside(c.label, spared) for c in heavy.children):
            break
        node = heavy
    return node


def _named(home: Node) -> bool:
    return home.label.split(".")[0] in ("article", "main")


def decide(root: Node) -> Node:
    """Mark the slots that hold the article, and the container and its parts, where a page may have more."""
    root.spared = _spared(root)
    home = _container(root)
    named = _named(home)

    def mark(node: Node, heading_only: bool) -> None:
        node.keep = True
        for child in node.children:
            if child.label == "#":
                # outside a named article, texts that are mostly links are the site's own
                stray = not named and child.repeated is False and 2 * child.linked > child.chars
                child.keep = not stray and (not heading_only or node.label.split(".")[0] in HEADINGS)
            elif not _aside(child.label, root.spared):
                mark(child, heading_only or child.label.split(".")[0] == "header")

    mark(home, False)
    return root


def extract(page: Node, wrapper: Node) -> str:
    """Texts of the page in the wrapper's kept slots, in page order.

    Parts of the article's container that the wrapper's sequence does not match are decided like the
    container: they stay but for side regions. A page without that container has one of its own.
    """
    out: list[tuple[str, bool, bool]] = []  # texts, whether they are constants of the host, whether headings
    home: Node | None = None  # the container, once the page has reached it
    spared = wrapper.spared

    def rest(node: Node, above: str, heading_only: bool) -> None:
        if node.label == "#":
            stray = not _named(home) and 2 * node.linked > node.chars
            if not stray and (not heading_only or above in HEADINGS):
                out.append((node.text, False, False))
        elif not _aside(node.label, spared):
            tag = node.label.split(".")[0]
            for child in node.children:
                rest(child, tag, heading_only or tag == "header")

    def walk(nodes: list[Node], pattern: Node, above: str, heading_only: bool) -> None:
        nonlocal home
        if pattern.keep and home is None:
            home = pattern
        folded = absorb(fold(nodes), pattern.children)
        for i, j in matches(folded, pattern.children):
            if i is None:
                continue
            if j is None:
                if pattern.keep:
                    for part in folded[i].parts:
                        for node in part:
                            rest(node, above, heading_only)
                continue
            slot = pattern.children[j]
            for part in folded[i].parts:
                if slot.label.startswith("("):
                    walk(part, slot, above, heading_only)
                    continue
                for node in part:
                    if node.label == "#":
                        if slot.keep:
                            constant = slot.pages >= CONSTANT_PAGES and node.constant in slot.common
                            out.append((node.text, constant, above in HEADINGS))
                    else:
                        tag = node.label.split(".")[0]
                        walk(node.children, slot, tag, slot.keep and (heading_only or tag == "header"))

    walk(page.children, wrapper, "", False)
    if home is None:
        alone = decide(stream(page))
        spared = alone.spared
        walk(page.children, alone, "", False)
    varied = not all(constant for _, constant, _ in out)
    return "\n\n".join(text for text, constant, heading in out if not constant or heading or not varied)


def stream(page: Node) -> Node:
    """The page as an expression of its own."""
    root = Node("")
    root.children = fold(page.children)
    return root


def pack(root: Node) -> str:
    return json.dumps([root.pack(), sorted(root.spared)], separators=(",", ":"))


def unpack(packed: str) -> Node:
    tree, spared = json.loads(packed)
    root = Node.unpack(tree)
    root.spared = frozenset(spared)
    return root


def host_of(url: str = "url"):
    """Lower-cased host; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer(pages: DataFrame) -> DataFrame:
    """host and wrapper of each host of ``pages`` (url, html)."""
    ship_code(pages.sparkSession)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Node] = {}
        for batch, pages in runs(batches, 1):
            for host, page in zip(batch.column(0).to_pylist(), pages, strict=True):
                own = stream(parse(page))
                found[host] = merged(found[host], own) if host in found else own
        salt = TaskContext.get().partitionId() % SALTS
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array([salt] * len(found), pa.int32()), pa.array(map(pack, found.values()), pa.string())], ["host", "salt", "wrapper"]
        )

    def join(group: pd.DataFrame) -> pd.DataFrame:
        packed = sorted(group["wrapper"])  # the same result whatever order they come in
        whole = unpack(packed[0])
        for one in packed[1:]:
            whole = merged(whole, unpack(one))
        return group.iloc[:1].assign(wrapper=pack(whole))

    schema = "host string, salt int, wrapper string"
    partial = pages.select(host_of().alias("host"), "html").mapInArrow(per_task, schema)
    salted = partial.groupBy("host", "salt").applyInPandas(join, schema)
    return salted.groupBy("host").applyInPandas(lambda g: join(g).assign(wrapper=lambda x: [pack(decide(unpack(w))) for w in x["wrapper"]]), schema).select("host", "wrapper")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages`` (page_id, url, html).

    A null or empty html has an empty text. Pages without a url share one wrapper. Null and repeated
    ids stay rows of their own; other columns are ignored.
    """
    ship_code(pages.sparkSession)
    wrappers = hand_off(infer(pages), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[str, Node]] = {}
        for batch, pages in runs(batches, 2):
            texts = []
            for page, packed in zip(pages, batch.column(3).to_pylist(), strict=True):
                key = hash(packed)
                if key not in known or known[key][0] != packed:
                    if len(known) > 256:
                        known.clear()
                    known[key] = (packed, unpack(packed))
                texts.append(extract(parse(page), known[key][1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of().alias("host"))
    # broadcast only if the written wrappers are small; else pages are shuffled by host and hot hosts split
    joined = rows.join(wrappers, "host").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long")
