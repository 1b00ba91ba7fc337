"""Main text of web pages by wrappers: union-free patterns inferred from the pages of one host, aligned one by one."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.shared import settle, short_batches

# HTML's elements by kind, and words in class, id and role that name what is not main text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form h1"
    " h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
SAME_CLOSES = frozenset("li dt dd option tr td th thead tbody tfoot optgroup".split())
DROPPED = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video nav footer aside form button"
    " select textarea dialog menu".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr"
    " notice notices notification popup modal overlay newsletter subscribe subscription sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs footer share sharing social related recommended recommendations comment comments"
    " discussion disqus respond replies login signup search toolbar pagination pager widget banner complementary"
    " contentinfo".split()
)
DROPPED_OUTSIDE = frozenset("header masthead topbar".split())
#: Dropped elements that may hold a whole page; elements that no name drops.
HOLDERS, NEVER_NAMED = frozenset(["form"]), frozenset("root html body main article h1 h2 h3 h4 h5 h6".split())
#: Of the words above, those that also name parts of articles; words that may stand beside the others in one name.
UNSURE = frozenset("discussion menu notice notices notification promotion related respond search sharing social".split())
FILLING = frozenset(
    "area bar block box button buttons container content entry form group icons inner item items left link links list"
    " main outer panel post posts right section slot stories top unit wrap wrapper".split()
)
NAMING = frozenset(["class", "id", "role"])
MAIN_TAGS, MAIN_WORDS = frozenset(["article", "main"]), frozenset(["main", "article"])
#: Words that may stand beside those in one name, and elements that no name makes a main element.
BODY_WORDS = frozenset("area body col column container content inner page post region section story text wrap wrapper".split())
NO_MAIN = frozenset("html body p h1 h2 h3 h4 h5 h6 li dt dd a br hr header".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FLOWING, PARTS = INLINE | {"br"}, SAME_CLOSES | {"ul", "ol", "dl", "table", "caption"}

#: Unmarked text that several pages of a host have alike is left out at the main text's edges alone, and only if there is
#: no more of it at that edge: there stand share lines and calls to subscribe, all else may be the article's own.
EDGE_CHARS = 60
#: Wrappers in all up to this size go to every executor; more are joined by host, with hot hosts salted.
SENT_BYTES, SALTS = 32 << 20, 16

#: Elements nested deeper than this are read as children of the last one that is not.
DEEPEST = 150

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>?|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


class Node:
    """A page's element or text (`#`), or a place of a wrapper that such nodes of several pages share."""

    __slots__ = ("symbol", "children", "text", "optional", "repeated", "chars", "constant", "page", "several", "place", "below", "holds_main")

    def __init__(self, symbol: str, text: str = ""):
        self.symbol, self.text, self.children = symbol, text, []
        self.optional = self.repeated = False
        self.chars = len(text)
        # A place's texts (their hashes) that every page with it has there; None for none.
        self.constant = None
        # A number of the page it is from, or of one of them, and whether different pages have it.
        self.page, self.several = 0, False


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, text): opening and closing tags, and text; comments, scripts, styles and titles are passed by."""
    for m in _TOKEN.finditer(html):
        whole = m[0]
        if m[3]:
            yield ("close" if m[2] else "open"), m[3].lower(), m[4]
        elif whole[0] != "<" or whole == "<":
            yield "text", "#", whole


def parse(html: str) -> Node:
    """The tree of a page, whose unclosed elements end where HTML says."""
    root = Node("root")
    stack = [root]
    for kind, name, text in tokens(html):
        if kind == "text":
            words = unescape(text)
            if words.strip():
                stack[-1].children.append(Node("#", words))
            elif stack[-1].children:
                stack[-1].children.append(Node("_", " "))
        elif kind == "open":
            if name in CLOSES_P or name in SAME_CLOSES:
                ends = "p" if name in CLOSES_P else name
                for k in range(len(stack) - 1, 0, -1):
                    tag = stack[k].symbol.partition(".")[0]
                    if tag == ends:
                        del stack[k:]
                        break
                    if tag not in INLINE and tag != "p":
                        break
            said = " ".join(a or b or c for n, a, b, c in _ATTRIBUTE.findall(text) if n.lower() in NAMING).split()
            names = ["-".join(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", n).lower())) for n in said]
            node = Node(".".join([name, *dict.fromkeys(n for n in names if n)]))
            stack[-1].children.append(node)
            if name not in VOID and not text.rstrip().endswith("/") and len(stack) < DEEPEST:
                stack.append(node)
        else:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].symbol.partition(".")[0] == name:
                    del stack[k:]
                    break
    return root


def is_dropped(node: Node, in_main: bool, whole: int) -> bool:
    """Whether a page's node, weighed before, is no main text by its tag or names; `whole` is the page's varying text.

    No name drops the page itself, a main element, a heading, or what holds a main element or most of the page's text.
    Inside the main text only a whole name counts (comments, ad-slot; not social-history), and one that is also a
    word of articles only if the text is the same on several pages.
    """
    tag, *names = node.symbol.split(".")
    if tag in DROPPED and tag not in HOLDERS:
        return True
    if tag in NEVER_NAMED or node.holds_main or 2 * node.below > whole:
        return False
    if tag in DROPPED:
        return True
    named = [n.split("-") for n in names]
    if not in_main:
        return tag == "header" or any(w in DROPPED_WORDS or w in DROPPED_OUTSIDE for n in named for w in n)
    for words in named:
        told = DROPPED_WORDS.intersection(words)
        if told and (not node.below or (told - UNSURE and FILLING.issuperset(set(words) - DROPPED_WORDS))):
            return True
    return False


def is_main(symbol: str) -> bool:
    """By tag, or by a whole name of main words (main, article-body) on an element that can hold blocks."""
    tag, *names = symbol.split(".")
    if tag in MAIN_TAGS or tag in INLINE or tag in NO_MAIN:
        return tag in MAIN_TAGS
    named = [n.split("-") for n in names]
    return any(MAIN_WORDS & {*n} and {*n} <= MAIN_WORDS | BODY_WORDS for n in named)


def _aligned(one: list[Node], two: list[Node]) -> Iterator[tuple[Node | None, Node | None]]:
    """Nodes of two sequences side by side: a longest common subsequence of their symbols, the rest alone."""
    n, m = len(one), len(two)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            same = one[i].symbol == two[j].symbol
            best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and one[i].symbol == two[j].symbol:
            yield one[i], two[j]
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            yield one[i], None
            i += 1
        else:
            yield None, two[j]
            j += 1


def merge(one: Node, two: Node, within: bool = False) -> Node:
    """The wrapper of two: what only one of them has is optional, what either repeats is repeated. `within` a page, all texts are its own."""
    out = Node(one.symbol)
    out.optional, out.repeated = one.optional or two.optional, one.repeated or two.repeated
    out.chars = one.chars + two.chars
    out.page, out.several = one.page, one.several or two.several or one.page != two.page
    if one.constant and two.constant:
        out.constant = one.constant | two.constant if within and not out.several else one.constant & two.constant or None
    for a, b in _aligned(one.children, two.children):
        if a and b:
            out.children.append(merge(a, b, within))
        else:
            alone = a or b
            alone.optional = True
            out.children.append(alone)
    out.children = _folded(out.children)
    return out


def _folded(nodes: list[Node], widest: int = 6) -> list[Node]:
    """Neighbours of equal symbols, then equal neighbouring groups of up to `widest`, as one that is repeated."""
    for width in range(1, widest + 1):
        at = 0
        while at + 2 * width <= len(nodes):
            first, second = nodes[at : at + width], nodes[at + width : at + 2 * width]
            if [a.symbol for a in first] == [b.symbol for b in second]:
                joined = [merge(a, b, True) for a, b in zip(first, second)]
                for node in joined:
                    node.repeated = True
                nodes = nodes[:at] + joined + nodes[at + 2 * width :]
            else:
                at += 1
    return nodes


def generalised(page: Node, number: int = 0) -> Node:
    """A page as the first guess of a wrapper: its repeated parts folded, what is never main text cut short."""
    out = Node(page.symbol, page.text)
    out.page = number
    out.constant = frozenset([_hash(page.text)]) if page.symbol == "#" else None
    children = [c for c in page.children if c.symbol != "_"]
    if page.symbol.partition(".")[0] not in DROPPED - HOLDERS:
        out.children = _folded([generalised(c, number) for c in children])
    return out


def _hash(text: str) -> int:
    """A number of 48 bits for a text, whatever its white space."""
    return int.from_bytes(blake2b(" ".join(text.split()).encode("utf-8", "replace"), digest_size=6).digest())


def to_json(node: Node) -> list:
    flags = node.optional + 2 * node.repeated + 4 * node.several
    constant = sorted(node.constant) if node.constant else None
    return [node.symbol, flags, node.chars, constant, node.page, [to_json(c) for c in node.children]]


def from_json(value: list) -> Node:
    node = Node(value[0])
    node.optional, node.repeated = bool(value[1] & 1), bool(value[1] & 2)
    node.several = bool(value[1] & 4)
    node.chars, node.constant, node.page = value[2], frozenset(value[3]) if value[3] else None, value[4]
    node.children = [from_json(c) for c in value[5]]
    return node


def _weighed(node: Node, place: Node | None) -> None:
    """Give each node of a page its place in the wrapper, and the characters of all and of varying text below it."""
    node.place, node.below, node.holds_main = place, 0, False
    if node.symbol == "#":
        node.chars = len(node.text.strip())
        node.below = node.chars if _varies(node, place) else 0
        return
    tag = node.symbol.partition(".")[0]
    places = iter(_placed(node.children, place.children if place else []))
    node.chars = 0
    for child in node.children:
        if child.symbol == "_":
            child.chars = child.below = 0
            child.place, child.holds_main = None, False
            continue
        _weighed(child, next(places))
        node.chars += child.chars
        node.below += child.below
        node.holds_main |= child.holds_main
    if tag in DROPPED and tag not in HOLDERS:
        node.chars, node.below, node.holds_main = 0, 0, False
    elif tag in MAIN_TAGS and node.chars:
        node.holds_main = True


def _varies(node: Node, place: Node | None) -> bool:
    """Whether a text may be the page's own: not one that all of several pages have at its place."""
    return place is None or not place.several or not place.constant or _hash(node.text) not in place.constant


def kept(node: Node, in_main: bool, whole: int) -> int:
    """Characters of varying text below `node` that are not dropped."""
    if not node.below or node.symbol == "#":
        return node.below
    return 0 if is_dropped(node, in_main, whole) else sum(kept(c, in_main, whole) for c in node.children)


def mains(node: Node, whole: int) -> list[Node]:
    """The topmost nodes of a page that are its main elements: by tag, or by name if they hold half of its text."""
    if node.symbol in ("#", "_") or is_dropped(node, False, whole):
        return []
    if is_main(node.symbol):
        if node.chars and (node.symbol.partition(".")[0] in MAIN_TAGS or 2 * kept(node, True, whole) >= max(whole, 1)):
            return [node]
    return [m for c in node.children for m in mains(c, whole)]


def region(page: Node, whole: int) -> Node:
    """Where no element is named main: the smallest node of the page that holds all of its varying, not dropped text.

    A header below the body counts where other pages show that its text varies, as that of an article does.
    """
    here = page
    while True:
        below_body = here.symbol.partition(".")[0] not in ("root", "html", "body")
        inner = [c for c in here.children if kept(c, False, whole) or (below_body and _is_own_header(c))]
        if len(inner) != 1 or inner[0].symbol == "#" or inner[0].symbol.partition(".")[0] in INLINE | {"p"}:
            return here
        here = inner[0]


def _is_own_header(node: Node) -> bool:
    return node.symbol.partition(".")[0] == "header" and _told(node)


def _told(node: Node) -> bool:
    """Whether several pages show that the text below a node varies."""
    if node.symbol == "#":
        return bool(node.place and node.place.several and node.below)
    return any(map(_told, node.children))


def _inner(nodes: list[Node], whole: int) -> set[int]:
    """Which nodes lie between the first and the last varying text of the main text, or hold either.

    The first is one below the headings, as a line under the title still stands at the edge. An edge with more common
    text than a few lines is part of the article.
    """
    leaves: list[tuple[Node, ...]] = []

    def walk(node: Node, above: tuple):
        if node.symbol == "#":
            leaves.append((*above, node))
        elif node.symbol != "_" and not is_dropped(node, True, whole):
            for child in node.children:
                walk(child, (*above, node))

    for node in nodes:
        walk(node, ())
    varying = [k for k, path in enumerate(leaves) if path[-1].below]
    if not varying:
        return set()
    body = [k for k in varying if not any(n.symbol.partition(".")[0] in HEADINGS for n in leaves[k])] or varying
    first, last = body[0], varying[-1]
    if sum(path[-1].chars for path in leaves[:first] if not path[-1].below) > EDGE_CHARS:
        first = 0
    if sum(path[-1].chars for path in leaves[last + 1 :]) > EDGE_CHARS:
        last = len(leaves)
    return {id(node) for path in leaves[first : last + 1] for node in path}


def _rank(node: Node) -> int:
    """1 to 6 for a heading, or what holds only one; else 0."""
    tag = node.symbol.partition(".")[0]
    if tag in HEADINGS:
        return int(tag[1])
    said = [c for c in node.children if c.chars]
    return _rank(said[0]) if len(said) == 1 and said[0].symbol != "#" else 0


def _own(nodes: list[Node], parts: bool) -> Iterator[bool]:
    """For each of the main text's neighbouring nodes whether it is the page's own, not the same on several pages.

    It is so with any varying text below it. Text and inline elements count as far as they run on, and alone only
    beside blocks. A heading belongs to what follows it, up to the next one of its rank; items and cells (`parts`)
    belong to their list or table.
    """
    block = [n.symbol not in ("#", "_") and n.symbol.partition(".")[0] not in FLOWING for n in nodes]
    if not any(block):
        yield from [True] * len(nodes)
        return
    for k, node in enumerate(nodes):
        if parts or node.below or (block[k] and node.symbol.partition(".")[0] in PARTS):
            yield True
        elif block[k]:
            rank, own = _rank(node), False
            for after in nodes[k + 1 :] if rank else []:
                if own or 0 < _rank(after) <= rank:
                    break
                own = after.below > 0
            yield own
        else:
            low = next((i + 1 for i in range(k, -1, -1) if block[i]), 0)
            high = next((i for i in range(k, len(nodes)) if block[i]), len(nodes))
            yield any(n.below for n in nodes[low:high])


def main_text(page: Node, wrapper: Node) -> str:
    """The text of the page's main elements, or else of its region in the wrapper, by blocks.

    What all of several pages have alike at one place is left out if it is short and stands before the first or after
    the last varying text; what lies between stays, as does all of a page that nothing varies in.
    """
    _weighed(page, wrapper)
    if not kept(page, False, page.below):  # a copy of the host's other pages: nothing of it varies
        _weighed(page, None)
    whole = page.below
    chosen = mains(page, whole) or [region(page, whole)]
    inner = _inner(chosen, whole)
    blocks: list[list[str]] = [[]]

    def take(node: Node, inside: bool):
        if node.symbol in ("#", "_"):
            if inside:
                blocks[-1].append(node.text)
            return
        inside = inside or any(node is c for c in chosen)
        if is_dropped(node, inside, whole):
            blocks.append([])
            return
        tag = node.symbol.partition(".")[0]
        inline = tag in INLINE
        if not inline:
            blocks.append([])
        every = [True] * len(node.children)
        for child, own in zip(node.children, _own(node.children, tag in PARTS) if inside and inner else every):
            if own or id(child) in inner:
                take(child, inside)
            else:
                blocks.append([])
        if not inline:
            blocks.append([])

    take(page, False)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def _placed(nodes: list[Node], places: list[Node]) -> list[Node | None]:
    """For each node of a page its place in the wrapper's sequence; repeated places take several nodes."""
    out: list[Node | None] = []
    at = 0
    for node in nodes:
        if node.symbol == "_":
            continue
        ahead = next((k for k in range(at, len(places)) if places[k].symbol == node.symbol), None)
        if ahead is None:  # a repeated group starts again
            ahead = next((k for k in range(at) if places[k].symbol == node.symbol), None)
        if ahead is not None:
            at = ahead
        out.append(places[ahead] if ahead is not None else None)
        if ahead is not None and not places[ahead].repeated:
            at = ahead + 1
    return out


def _first_guesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to (host, wrapper, pages): the wrapper of each batch's pages of a host."""
    for batch in batches:
        held: dict[str, tuple[Node, int]] = {}
        for host, html in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
            guess = generalised(parse(html or ""), crc32((html or "").encode("utf-8", "replace")))
            before = held.get(host)
            held[host] = (merge(before[0], guess), before[1] + 1) if before else (guess, 1)
        yield _wrappers((h, w, n) for h, (w, n) in held.items())


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers sorted by host to one for each host, held one at a time."""
    held: tuple[str, Node, int] | None = None
    for batch in batches:
        out = []
        for host, wrapper, pages in zip(*(batch.column(k).to_pylist() for k in range(3))):
            node = from_json(json.loads(wrapper))
            if held and held[0] == host:
                held = (host, merge(held[1], node), held[2] + pages)
            else:
                out += [held] if held else []
                held = (host, node, pages)
        yield _wrappers(out)
    if held:
        yield _wrappers([held])


def _wrappers(rows) -> pa.RecordBatch:
    rows = [(h, json.dumps(to_json(w), ensure_ascii=False), n) for h, w, n in rows]
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["host", "wrapper", "pages"]
    )


def _host(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


WRAPPERS = "host string, wrapper string, pages long"


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper, pages): the wrapper of every host, from all of its pages.

    Each task aligns the pages it reads, host by host; the wrappers of a host, one from each batch of pages, are then
    aligned with each other in two rounds, so a host of many pages is shared by many tasks.
    """
    read = short_batches(pages).select(_host(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    guesses = read.mapInArrow(_first_guesses, WRAPPERS)
    salted = guesses.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    some = salted.repartition("host", "salt").sortWithinPartitions("host", "salt").select("host", "wrapper", "pages")
    parts = some.mapInArrow(_merged, WRAPPERS)
    return parts.repartition("host").sortWithinPartitions("host").mapInArrow(_merged, WRAPPERS)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, Node] = {}
    for batch in batches:
        texts = []
        for html, host, wrapper in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
            if host not in known:
                known[host] = from_json(json.loads(wrapper))
            texts.append(main_text(parse(html or ""), known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages`.

    Blocks of the main text stand one to a line, white space within a block is one space. A page that has an article
    or main element gives the text of those; any other page the smallest part that holds all of its text that varies
    between the pages of its host. Of both, blocks that are the same on all pages that have their place in the wrapper
    (two different ones at least) are left out: share lines, notices. Headings of what stays, items of lists and cells
    stay, and so does all of a page of which less than a quarter varies, as it is a copy of others. Menus, headers and footers of the page, sidebars, notices, adverts, forms, comments, scripts
    and styles are left out. A null or empty html gives an empty text; a null or odd url belongs to the host "".
    Rows that repeat stay; extra columns are ignored.
    """
    wrappers = settle(infer_wrappers(pages, url_col, html_col))
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    read = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
        _host(F.col(url_col)).alias("host"),
    )
    if size <= SENT_BYTES:
        joined = read.join(F.broadcast(wrappers), "host")
    else:
        read = read.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)))
        copies = wrappers.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = read.join(copies, ["host", "salt"])
    return joined.select("page_id", "url", "html", "host", "wrapper").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long"
    )
