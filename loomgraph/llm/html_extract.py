"""Main text of web pages by wrappers: union-free expressions inferred from pages of the same host.

A page's token stream (tags and texts) is nested by its tags. Streams of one host are
aligned one after another: equal tags match, texts that differ become slots, a run of
like groups becomes a repeated group and what only some pages have an optional one.
The wrapper so found says where the host's article lies and which texts are the
template's own. Every page is then read whole through its host's wrapper; a page
that doesn't fit it is read through the wrapper of its own stream.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import written
from loomgraph.llm.url_filter import host_of

#: Hosts whose partial wrappers a task holds at once, and the shares in which a host's partial wrappers are merged first.
HOSTS, SHARES = 256, 16
#: Neighbours beyond which those with the same key become one repeated part.
WIDE = 64
#: Elements nested deeper than this stand beside each other in the one at this depth, as browsers do it.
DEEP = 128
#: Bytes of all wrappers up to which they are broadcast; beyond, they join by shuffle.
BROADCAST = 16 << 20

#: Fixed values of HTML: elements without content, with raw text, and those that a start tag closes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
    "tr", "ul",
}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
#: A closing or implied end reaches no further out than these.
WALLS = {"table", "td", "th", "ul", "ol", "dl", "article", "main", "section", "body", "html", "div", "nav", "aside", "footer", "header", "form"}
ENDS_P = BLOCK - {"br", "html", "body", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dd", "dt", "legend", "summary"}
WRITTEN = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "blockquote", "pre", "article", "main", "body"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What is never the article: elements, roles, and words of class or id.
OFF_TAGS = {
    "head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "datalist", "svg", "math", "canvas", "object",
    "embed", "applet", "audio", "video", "dialog", "menu", "template", "label", "input",
} | RAW
OFF_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
OFF_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adslot", "sponsor", "sponsored", "promo", "promoted",
    "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar",
    "related", "recommended", "recommendations", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert",
    "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "comment",
    "comments", "disqus", "reply", "replies", "responses", "widget", "toolbar", "pagination", "pager", "search", "paywall", "disclaimer",
}
MARK = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "key", "off", "kids", "flat")

    def __init__(self, tag: str, key: str, off: bool):
        self.tag, self.key, self.off, self.kids, self.flat = tag, key, off, [], False


def _node(tag: str, attributes: str) -> Node:
    key, off = tag, tag in OFF_TAGS
    if attributes and not attributes.isspace():
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)}
        names = f"{found.get('class', '')} {found.get('id', '')}".strip()
        if names:
            key += "." + re.sub(r"\d+", "0", names.split()[0])
        words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower())
        if tag not in ("html", "body", "article", "main"):
            off = off or any(w in OFF_WORDS and (not i or words[i - 1] not in ("has", "no", "with", "without")) for i, w in enumerate(words))
            off = off or found.get("role", "").lower() in OFF_ROLES or found.get("aria-hidden", "").lower() == "true"
            off = off or bool(re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes)) or "display:none" in found.get("style", "").replace(" ", "").lower()
        if found.get("role", "").lower() == "main":
            key = "main"
    return Node(tag, key, off)


def tree(page: str) -> Node:
    """The page's token stream nested by its tags; texts are decoded strings among the children.

    Ends that are left out, in wrong order or missing at the end are supplied. Beyond ``DEEP``
    open elements a further one adds its texts to the last of these, parted where it is a block; what is
    never the article adds none.
    """
    root = Node("#root", "#root", False)
    stack, open_, at, size = [root], Counter(), 0, len(page)

    def close(i: int) -> None:
        for node in stack[i:]:
            open_[node.tag] -= 1
            if node.flat and node.tag in BLOCK:
                node.kids.append(Node(node.tag, node.tag, False))
        del stack[i:]

    def put(node: Node, opens: bool) -> None:
        above = stack[-1].kids
        if len(stack) <= DEEP:
            above.append(node)
        else:
            if node.tag in BLOCK:
                above.append(Node(node.tag, node.tag, False))
            node.flat = not node.off
            if node.flat:
                node.kids = above
        if opens:
            stack.append(node)
            open_[node.tag] += 1

    while at < size:
        m = MARK.search(page, at)
        if not m:
            stack[-1].kids.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            stack[-1].kids.append(html.unescape(page[at : m.start()]))
        at = max(m.end(), m.start() + 1)
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                stack[-1].kids.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if open_[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in WALLS and tag not in WALLS:
                    break
            continue
        closes = {"p"} if tag in ENDS_P else CLOSES.get(tag, ())
        if any(open_[c] for c in closes):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closes:
                    close(i)
                    break
                if stack[i].tag in WALLS and stack[i].tag not in closes:
                    break
        # In HTML a slash doesn't end an element, but for those of drawings.
        ended = m[3].rstrip().endswith("/") and tag in ("svg", "path", "g")
        put(_node(tag, m[3]), tag not in VOID and tag not in RAW and not ended)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]|</{tag}$", re.IGNORECASE).search(page, at)
            at = end.start() if end else size
            if end:
                at = (page.find(">", end.start()) + 1) or size
    return root


# A wrapper's part is [key, off, seen, repeated, words, link words, text or None, parts]. seen counts the
# pages that have it; text is there while all pages agree on it.
KEY, OFF, SEEN, REPEATED, WORDS, LINKS, TEXT, PARTS = range(8)


def skeleton(node: Node | str, link: bool = False) -> list | None:
    """The expression of one page: like neighbours folded into repeated groups, texts as hashes."""
    if isinstance(node, str):
        words = len(node.split())
        return ["#", False, 1, False, words, words * link, zlib.crc32(" ".join(node.split()).encode("utf-8", "replace")), []] if words else None
    parts = [p for p in (skeleton(k, link or node.tag == "a") for k in node.kids) if p]
    out = [node.key, node.off, 1, False, sum(p[WORDS] for p in parts), sum(p[LINKS] for p in parts), None, fold(parts)]
    return out


def fold(parts: list) -> list:
    """Runs of like parts, or of like pairs or triples, as one repeated group each."""
    for period in (1, 2, 3):
        out: list = []
        for part in parts:
            out.append(part)
            while len(out) >= 2 * period and [p[KEY] for p in out[-period:]] == [p[KEY] for p in out[-2 * period : -period]]:
                if period == 1 and out[-1][KEY] == "#":
                    break
                last = out[-period:]
                del out[-period:]
                out[-period:] = [merge(a, b, True) for a, b in zip(out[-period:], last)]
        parts = out
    return parts


def merge(a: list, b: list, repeat: bool = False, inside: bool = False) -> list:
    """The least expression for both: the same key, aligned parts. With ``repeat`` they are neighbours
    on one page, ``inside`` parts of such: that adds no page that has them."""
    inside = inside or repeat
    seen = max(a[SEEN], b[SEEN]) if inside else a[SEEN] + b[SEEN]
    text = a[TEXT] if a[TEXT] == b[TEXT] else None
    parts = align(a[PARTS], b[PARTS], inside)
    return [a[KEY], a[OFF] or b[OFF], seen, a[REPEATED] or b[REPEATED] or repeat, a[WORDS] + b[WORDS], a[LINKS] + b[LINKS], text, parts]


def align(a: list, b: list, inside: bool = False) -> list:
    """Both lists in order: what matches is merged, what only one has stays with its own count (optional)."""
    if not a or not b:
        return a or b
    one, two = [p[KEY] for p in a], [p[KEY] for p in b]
    if one == two:
        return [merge(x, y, inside=inside) for x, y in zip(a, b)]
    out: list = []
    for what, i, j, k, n in SequenceMatcher(None, one, two, autojunk=False).get_opcodes():
        if what == "equal":
            out += [merge(x, y, inside=inside) for x, y in zip(a[i:j], b[k:n])]
        else:
            out += a[i:j] + b[k:n]
    out = fold(out)
    return out if len(out) <= WIDE else gather(out)


def gather(parts: list) -> list:
    """One repeated part for all of a key, at the first's place; so a wrapper is bounded by its keys, not its pages."""
    found: dict[str, list] = {}
    for part in parts:
        key = part[KEY]
        found[key] = merge(found[key], part, True) if key in found else part
    return list(found.values())


def pattern(part: list, pages: int | None = None) -> str:
    """A wrapper as text: ``#`` a slot, ``'`` a text of the template, ``+`` repeated, ``?`` optional."""
    pages = part[SEEN] if pages is None else pages
    mark = ("+" if part[REPEATED] else "") + ("?" if part[SEEN] < pages else "")
    if part[KEY] == "#":
        return ("#" if part[TEXT] is None else "'") + mark
    inner = " ".join(pattern(p, pages) for p in part[PARTS])
    return f"{part[KEY]}({inner}){mark}" if inner else part[KEY] + mark


def locate(wrapper: list) -> tuple[list[str], list[int]]:
    """Where the article lies (keys from the root; empty if nowhere) and the template's own texts inside it.

    It is the largest article element if it has half of main's words, else main, both
    outside of what is never the article (a class name alone doesn't rule out a part
    with an article and most of the page's words); else the innermost part with four fifths of the words that are neither
    off nor in links. A text is the template's own if it is all of a block that isn't a
    paragraph, heading, list item or cell, and four pages or more agree on it while other
    texts of the article differ. Articles of the host's other layouts (elsewhere, neither around
    this one nor inside it) add theirs.
    """
    best: dict[str, tuple[int, list[str], list]] = {}
    places: list[tuple[list[str], list]] = []

    def good(part: list) -> int:
        """Words of a part that may be the article's."""
        if part[OFF]:
            return 0
        return max(0, part[WORDS] - 2 * part[LINKS]) if part[KEY] == "#" else sum(map(good, part[PARTS]))

    def walk(part: list, path: list[str]) -> None:
        if part[OFF] and not (holds(part) and part[WORDS] >= 0.6 * wrapper[WORDS]):
            return
        here = [*path, part[KEY]]
        kind = part[KEY].split(".")[0]
        if kind in ("article", "main"):
            places.append((here, part))
            if (n := good(part)) > best.get(kind, (0,))[0]:
                best[kind] = (n, here, part)
        for p in part[PARTS]:
            walk(p, here)

    walk(wrapper, [])
    if best:
        article, main = best.get("article", (0,)), best.get("main", (0,))
        _, path, part = article if article[0] >= 0.5 * main[0] and article[0] else main if main[0] else max(best.values(), key=len)
    else:
        path, part, total = [wrapper[KEY]], wrapper, good(wrapper)
        if not total:
            return [], []
        while inner := [p for p in part[PARTS] if p[KEY].split(".")[0] in BLOCK - {"p", "br", "li"} and good(p) >= 0.8 * total and not p[REPEATED]]:
            part = inner[0]
            path.append(part[KEY])
    own: list[int] = []
    found: list[int] = []
    differ = False

    def texts(p: list) -> None:
        nonlocal differ
        differ = differ or p[KEY] == "#" and p[TEXT] is None
        if len(p[PARTS]) == 1 and p[KEY].split(".")[0] in BLOCK - WRITTEN and not p[REPEATED]:
            (only,) = p[PARTS]
            if only[KEY] == "#" and only[TEXT] is not None and only[SEEN] >= 4 and not only[REPEATED]:
                found.append(only[TEXT])
        for x in p[PARTS]:
            texts(x)

    for here, other in [(path, part), *(x for x in places if x[0][: len(path)] != path[: len(x[0])])]:
        found, differ = [], False
        texts(other)
        own += found if differ else []
    return path, list(dict.fromkeys(own))


def holds(part: list) -> bool:
    """Whether an article or main lies inside a part that only its class or role rules out."""
    return part[KEY].split(".")[0] not in OFF_TAGS and any(p[KEY].split(".")[0] in ("article", "main") or holds(p) for p in part[PARTS])


def text_of(node: Node, own: set[int]) -> str:
    """The node's text by blocks, without what is never the article and the template's own texts."""
    blocks: list[str] = []
    run: list[str] = []
    menus: set[int] = set()
    _menus(node, menus)

    def flush() -> None:
        if run:
            block = SPACE.sub(" ", "".join(run)).strip()
            if block:
                blocks.append(block)
            run.clear()

    def walk(n: Node, headings_only: bool) -> None:
        for k in n.kids:
            if isinstance(k, str):
                if not headings_only and not (own and zlib.crc32(" ".join(k.split()).encode("utf-8", "replace")) in own):
                    run.append(k)
            elif not k.off:
                if k.tag in BLOCK:
                    flush()
                if id(k) not in menus:
                    walk(k, headings_only and k.tag not in HEADINGS)
                if k.tag in BLOCK:
                    flush()
            elif k.tag == "header":  # the article's own: its headings stay
                flush()
                walk(k, True)
                flush()
            elif k.tag in BLOCK:
                flush()

    walk(node, False)
    flush()
    return " ".join(blocks)


def _menus(node: Node, found: set[int]) -> tuple[int, int, int]:
    """Links, words and words in links below a node; ``found`` gets its blocks that are menus: three links or more that hold four fifths of the words."""
    links = words = inside = 0
    for k in node.kids:
        if isinstance(k, str):
            words += len(k.split())
        elif k.kids and not k.flat:
            n, w, i = _menus(k, found)
            link = k.tag == "a"
            links, words, inside = links + n + link, words + w, inside + (w if link else i)
    if node.tag in BLOCK and node.tag not in ("p", "br") and links >= 3 and inside >= 0.8 * words:
        found.add(id(node))
    return links, words, inside


def _find(node: Node, path: list[str]) -> Node | None:
    """The node with most text whose keys from the root are ``path``."""
    found = [node] if node.key == path[0] else []
    for key in path[1:]:
        found = [k for n in found for k in n.kids if isinstance(k, Node) and k.key == key]
    return max(found, key=_weight, default=None)


def _weight(node: Node) -> int:
    return sum(len(k) if isinstance(k, str) else (0 if k.off else _weight(k)) for k in node.kids)


def extract(page: str | None, path: list[str], own: set[int]) -> str:
    """The main text of a page by its host's wrapper, or by its own if that doesn't fit."""
    if not page:
        return ""
    root = tree(page)
    node = _find(root, path) if path else None
    if node is None:
        path, _ = locate(skeleton(root))
        node = _find(root, path) if path else None
    return text_of(node, own) if node is not None else ""


def infer(skeletons: list[list]) -> list:
    """The wrapper of a host's pages, aligned one after another."""
    wrapper = skeletons[0]
    for s in skeletons[1:]:
        wrapper = merge(wrapper, s)
    return wrapper


def wrappers(pages: DataFrame) -> DataFrame:
    """host, path, own and pattern: one wrapper per host, from all of its pages.

    A task merges the folded expressions of each host's pages as it reads them; what is
    shuffled are these partial wrappers, never pages. They are merged in ``SHARES`` by the
    task first, so that a hot host's don't all meet in one, and then by host.
    """

    def outline(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list] = {}

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array([share] * len(held), pa.int32())]
            texts = [json.dumps(w, separators=(",", ":")) for w in held.values()]
            return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=["host", "share", "outline"])

        share = TaskContext.get().partitionId() % SHARES
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    one = skeleton(tree(page or ""))
                    held[host] = merge(held[host], one) if host in held else one
                    if len(held) >= HOSTS:
                        yield out()
                        held.clear()
        if held:
            yield out()

    def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [json.dumps(infer([json.loads(o) for o in sorted(outlines)]), separators=(",", ":")) for outlines in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["host", "outline"])

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], []]
            for outlines in batch.column(1).to_pylist():
                wrapper = infer([json.loads(o) for o in sorted(outlines)])
                path, own = locate(wrapper)
                for column, value in zip(rows, (path, own, pattern(wrapper))):
                    column.append(value)
            types = (pa.list_(pa.string()), pa.list_(pa.int64()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows, types)], names=["host", "path", "own", "pattern"])

    outlined = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(outline, "host string, share int, outline string")
    shared = outlined.groupBy("host", "share").agg(F.collect_list("outline").alias("outlines")).select("host", "outlines")
    partial = shared.mapInArrow(together, "host string, outline string")
    gathered = partial.groupBy("host").agg(F.collect_list("outline").alias("outlines"))  # SHARES of each host at most
    return gathered.mapInArrow(joined, "host string, path array<string>, own array<long>, pattern string")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``, from its whole html (null: empty).

    Pages without a host form one group. Rows repeated stay repeated. Columns other than
    page_id, url and html are not read. Wrappers are broadcast while all of them are
    under ``BROADCAST`` bytes; beyond that pages join them by host.
    """
    found = written(wrappers(pages), "wrappers")
    size = found.agg(F.sum(F.length(F.to_json(F.struct("host", "path", "own"))))).first()[0] or 0
    side = found.select(F.col("host").alias("_host"), "path", "own")
    placed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("_h"))
    joined = placed.join(F.broadcast(side) if size <= BROADCAST else side, F.col("_h") == F.col("_host"), "left")
    ddl = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [extract(p, w or [], set(o or ())) for p, w, o in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return joined.select("page_id", "url", "html", "path", "own").mapInArrow(run, ddl)
