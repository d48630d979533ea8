"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of style nodes, menus and adverts too: an element's node is its tag, its style
(classes, role) and the nodes above it.  For every style node the entropy of its layout (what stands below it, and how often)
and of its content over the host's pages tells how much it matters.  Cut from each page are branches that read the same on
every page, and beside the host's text small branches that look the same on every page, whatever they say: a menu has its six
entries and a footer its one line where an article has one to thirty paragraphs.  What differs from page to page like an
article (reader comments, teasers) entropy cannot tell; there, and on hosts with few pages, the declared tags and styles do.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewatch.functions.scratch import stored

#: Pages that must have a style node before its entropy is judged.
MIN_PAGES = 8
MIN_IMPORTANCE = 0.15
CONTENT_WEIGHT = 0.9
#: A branch whose layout has less entropy looks the same on every page.
MIN_LAYOUT = 0.4
#: Shares of a host's text: a branch with no more may be cut for its layout; text blocks next to each other with more are its text.
SMALL_BRANCH = 0.25
TEXT_BLOCKS = 0.25
#: Levels of style nodes, and of open elements; deeper elements count as part of the last level, as browsers do.
MAX_LEVELS = 64
MAX_DEPTH = 512

# Elements and style words that are not part of an article.
NOISE_TAGS = frozenset(
    "head title nav footer aside form menu dialog button select textarea input label fieldset script style noscript template "
    "iframe svg canvas object embed audio video map math".split()
)
RAW_TAGS = frozenset("script style textarea title noscript template iframe svg xmp noembed noframes math".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK_TAGS - frozenset("body caption html li dd dt td th tr tbody thead tfoot".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login signin "
    "menu menus submenu nav navbar navigation breadcrumb breadcrumbs crumbs sidebar sidebars sidenav rail widget widgets footer "
    "foot masthead topbar toolbar comment comments commentlist discussion disqus respond reply replies share sharing social "
    "related recommended recommendation recommendations trending pagination pager search skip skiplink copyright disclaimer "
    "hidden paywall".split()
)
#: What may stand beside a noise word in a class or id that declares noise ("site-footer", "cookie-bar", but not "no-sidebar").
NEUTRAL_WORDS = frozenset(
    "site page main primary secondary global top bottom left right upper lower inner outer box bar bars block blocks list lists link "
    "links item items wrap wrapper container section area panel slot unit button buttons btn icon icons text message messages title "
    "header entry post posts article articles story stories form field group row col column my wp js mobile desktop fixed sticky "
    "visually screen thread count view policy settings strip zone holder placeholder frame google this us tab tabs trail email "
    "inline horizontal vertical latest popular more".split()
)
#: Elements that are noise unless they hold the article; forms of some frameworks are around whole pages.
HOLDERS = frozenset("form fieldset".split())
#: Shares of a page's text: an element with more is most of it, an article with no more is a teaser.
MOST = 0.5
TEASER = 0.1
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*+)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|$)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
STYLE_WORD = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Node:
    """An open element: its style signature, whether it is cut, the elements of declared noise, article and main around it."""

    tag: str
    signature: int
    noise: bool
    declared: tuple[int, ...]
    article: int
    main: bool
    header: bool
    path: tuple[int, ...] = ()
    block: Node | None = None


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[int, ...]
    header: bool
    article: int
    main: bool
    tag: str = ""


@dataclass(slots=True)
class Region:
    """An article or main element: the declared noise around it (itself too), the path to it, its characters."""

    declared: tuple[int, ...]
    path: tuple[int, ...]
    main: bool
    chars: int = 0


@lru_cache(maxsize=20_000)
def _signature(parent: int, tag: str, style: str) -> int:
    return xxhash.xxh64_intdigest(f"{tag} {style}", parent) >> 1


@lru_cache(maxsize=20_000)
def _raw_end(tag: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I)


def _declares(token: str) -> bool:
    """Whether a class or id as a whole names noise."""
    words = [w for w in STYLE_WORD.findall(CAMEL.sub(" ", token).lower()) if len(w) > 1]
    if NOISE_WORDS.isdisjoint(words):
        return False
    return words[0] in ("skip", "skiplink") or all(w in NOISE_WORDS or w in NEUTRAL_WORDS for w in words)


@lru_cache(maxsize=20_000)
def _style(attributes: str, heading: bool = False) -> tuple[str, bool]:
    """The part of the attributes that makes a style, and whether it declares noise. A heading's id only repeats its text."""
    if not attributes or attributes.isspace():
        return "", False
    parts, noise = [], False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            noise = noise or not (heading and name == "id") and any(map(_declares, value.split()))
            if name == "class":
                parts.append(value)
        elif name == "role":
            noise = noise or value.lower() in NOISE_ROLES
            parts.append(value)
        elif name == "hidden":
            noise = True
        elif name == "aria-hidden":
            noise = noise or value.lower() == "true"
        elif "display:none" in value.replace(" ", "").lower():
            noise = True
    return " ".join(parts), noise


def _spared(pieces: list[tuple[str, Node]], regions: list[Region]) -> set[int]:
    """The elements of declared noise that hold the page's main or article or most of its text, so that they are not cut.

    An element with most of the text is cut all the same if an article or main beside it holds more than a teaser does.
    """
    held: dict[int, int] = {}
    beside: dict[int, int] = {}
    total = in_regions = 0
    for text, node in pieces:
        n = 0 if node.header else len(text.strip())
        if not n:
            continue
        total += n
        inside = n if node.article or node.main else 0
        in_regions += inside
        if node.article:
            regions[node.article - 1].chars += n
        for k in node.declared:
            held[k] = held.get(k, 0) + n
            beside[k] = beside.get(k, 0) - inside
    spared = {k for k, n in held.items() if n > MOST * total and in_regions + beside[k] <= TEASER * total}
    articles = [r for r in regions if not r.main]
    whole = sum(r.chars for r in articles)
    for r in regions:
        if r.main or r.chars > MOST * whole and r.chars >= TEASER * total:
            spared.update(r.declared)
    return spared


def blocks_of(page: str | None, whole: bool = False) -> tuple[list[Block], dict[int, list[int]], list[Region]]:
    """Text blocks outside declared noise (``whole``: all) in page order, with the style nodes above each, each node's
    children, and the page's articles and main elements; a block's ``article`` is its place in that list, from 1.

    Unclosed and crossing elements are closed as browsers do in the common cases; what a page lacks at its end is implied.
    """
    page = page or ""
    root = Node("", 0, False, (), 0, False, False)
    stack, kinds = [root], {}
    found_blocks: list[tuple[list[tuple[str, Node]], tuple[int, ...], Node]] = []
    regions: list[Region] = []
    n_declared = 0
    pieces: list[tuple[str, Node]] = []
    opened: dict[str, int] = {}
    at, end = 0, len(page)

    def put(text: str) -> None:
        if not stack[-1].noise:
            pieces.append((text, stack[-1]))

    def flush() -> None:
        if pieces:
            found_blocks.append((pieces.copy(), stack[-1].path, stack[-1].block or root))
            pieces.clear()

    def close(tags: frozenset[str] | set[str], until: frozenset[str] | set[str]) -> None:
        if not any(map(opened.get, tags)):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                for node in stack[i:]:
                    opened[node.tag] -= 1
                del stack[i:]
                return
            if stack[i].tag in until:
                return

    while at < end:
        start = page.find("<", at)
        if start < 0:
            put(page[at:])
            break
        if start > at:
            put(page[at:start])
        found = TOKEN.match(page, start)
        if found is None:
            put("<")
            at = start + 1
            continue
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if tag is None:
            if page.startswith("<![CDATA[", start):
                put(html_entities.escape(page[start + 9:at].removesuffix("]]>")))
            continue
        tag = tag.lower()
        is_block = tag in BLOCK_TAGS
        if is_block:
            flush()
        if found["end"] or found["end2"]:
            if tag == "br":
                put(" ")
            elif tag not in VOID_TAGS:
                close({tag}, frozenset() if is_block else BLOCK_TAGS)
            continue
        if tag in RAW_TAGS:
            stop = _raw_end(tag).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID_TAGS:
            if tag in ("br", "hr", "wbr", "img"):
                put("" if tag == "wbr" else " ")
            continue
        if tag in CLOSES_P:
            close({"p"}, {"table", "td", "th", "button", "object"})
        if tag == "li":
            close({"li"}, {"ul", "ol", "menu", "dir"})
        elif tag in ("dt", "dd"):
            close({"dt", "dd"}, {"dl"})
        elif tag in ("td", "th"):
            close({"td", "th"}, {"tr", "table"})
        elif tag == "tr":
            close({"tr"}, {"table", "tbody", "thead", "tfoot"})
        elif tag in ("tbody", "thead", "tfoot"):
            close({"tbody", "thead", "tfoot"}, {"table"})
        elif tag == "option":
            close({"option"}, {"select"})
        elif tag in HEADINGS:
            close(HEADINGS, BLOCK_TAGS - HEADINGS)
        if len(stack) > MAX_DEPTH:
            opened[stack.pop().tag] -= 1
        opened[tag] = opened.get(tag, 0) + 1
        parent = stack[-1]
        if parent.noise:
            stack.append(Node(
                tag, parent.signature, True, parent.declared, parent.article, parent.main, parent.header, parent.path, parent.block))
            continue
        attributes = found["attributes"] or found["attributes2"] or ""
        style, is_declared = _style(attributes, tag in HEADINGS)
        root_like = tag in ("html", "body")
        noise = tag in NOISE_TAGS and tag not in HOLDERS and not whole
        declared = parent.declared
        if not whole and not root_like and (is_declared or tag in HOLDERS):
            n_declared += 1
            declared = (*declared, n_declared)
        article, main = parent.article, parent.main or (tag == "main" or "main" in style.split()) and not noise
        if tag == "article" and not article or main and not parent.main:
            regions.append(Region(declared, parent.path, tag != "article"))
            if tag == "article":
                article = len(regions)
        # A page's header is cut; of an article's header the headings stay.
        header = not root_like and (tag == "header" or parent.header) and not (parent.article and tag in HEADINGS)
        if parent.header and parent.article and tag in HEADINGS:
            header = False
        signature, path = parent.signature, parent.path
        if is_block and len(path) < MAX_LEVELS:
            signature = _signature(parent.signature, tag, style)
            path = (*path, signature)
            kinds.setdefault(parent.signature, []).append(signature)
        made = Node(tag, signature, noise, declared, article, bool(main), header, path, parent.block)
        if is_block:
            made.block = made
        stack.append(made)
    flush()
    spared = _spared([p for ps, _, _ in found_blocks for p in ps], regions) if n_declared else set()
    blocks = []
    for parts, path, node in found_blocks:
        text = "".join(t for t, n in parts if not n.declared or spared.issuperset(n.declared))
        if "&" in text:
            text = html_entities.unescape(text)
        text = " ".join(text.split())
        if text:
            blocks.append(Block(text, path, node.header, node.article, node.main, node.tag))
    return blocks, kinds, regions


@dataclass(slots=True)
class StyleRow:
    """A style node on one page: hashes of the layout below it and of its content, characters below it and in text blocks that
    are its children, and the nodes above it."""

    node: int
    layout: int
    content: int
    chars: int
    direct: int
    above: tuple[int, ...]


def style_rows(page: str | None) -> list[StyleRow]:
    """The style nodes of a page that hold text, noise as well."""
    blocks, kinds, _ = blocks_of(page, whole=True)
    content: dict[int, xxhash.xxh64] = {}
    above: dict[int, tuple[int, ...]] = {}
    chars: dict[int, int] = {}
    direct: dict[int, int] = {}
    for block in blocks:
        text, n = block.text.encode(), len(block.text)
        for level, node in enumerate(block.path):
            if node not in content:
                content[node], above[node] = xxhash.xxh64(), block.path[:level]
            content[node].update(text)
            chars[node] = chars.get(node, 0) + n
        for node in block.path[-2:]:
            direct[node] = direct.get(node, 0) + n
    layouts: dict[int, int] = {}
    for node in sorted(kinds, key=lambda k: -len(above.get(k, ()))):  # children before what is above them
        children = sorted(Counter(k for k in kinds[node] if k in content).items())
        layouts[node] = xxhash.xxh64_intdigest(repr([(k, n, layouts.get(k, 0)) for k, n in children]).encode()) >> 1
    return [
        StyleRow(node, layouts.get(node, 0), digest.intdigest() >> 1, chars[node], direct.get(node, 0), above[node])
        for node, digest in content.items()
    ]


def _beside(block: Block, region: Region) -> bool:
    """Whether a block before an article is its title or lead: an h1 next to it or higher, a paragraph next to it."""
    above = block.path[:-1]
    return block.tag == "h1" and above == region.path[:len(above)] or block.tag == "p" and above == region.path


def main_text(page: str | None, cut: frozenset[int] | set[int] = frozenset()) -> str:
    """The article's blocks, two line feeds between them, without the branches below the style nodes ``cut``.

    A node that holds all text of the page is not cut, and nothing is cut from a page of which nothing would be left.  Articles
    (else the main element) are taken for the page only where they hold most of the text that is left.
    """
    found, _, regions = blocks_of(page)
    blocks = [b for b in found if not b.header]
    if cut and blocks:
        cut = cut - set(blocks[0].path).intersection(*[b.path for b in blocks[1:]])
    left = [b for b in blocks if cut.isdisjoint(b.path)] or blocks
    whole = sum(len(b.text) for b in left)
    for name in ("article", "main"):
        inside = [i for i, b in enumerate(left) if getattr(b, name)]
        if inside and sum(len(left[i].text) for i in inside) >= MOST * whole:
            first = left[inside[0]]
            region = regions[first.article - 1] if first.article else None
            left = [b for i, b in enumerate(left) if getattr(b, name) or region and i < inside[0] and _beside(b, region)]
            break
    return "\n\n".join(b.text for b in left)


def host_of(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, node, m (pages), layout and content (entropies from 0 to 1), chars, direct, above: the hosts' style trees.

    ``pages`` has the columns host and html.  Pages of a host with equal style nodes and texts count once, so a group of
    copies doesn't make an article look like a notice.  Counts are partial aggregates over (host, node, hash); no host's
    pages meet in one task.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, rows = [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = style_rows(page)
                digest = xxhash.xxh64_intdigest(repr([(r.node, r.layout, r.content) for r in found]).encode()) >> 1
                for r in found:
                    hosts.append(host)
                    rows.append((r.node, r.layout, r.content, r.chars, r.direct, digest, r.above))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.list_(pa.int64()))],
                ["host", "node", "layout", "content", "chars", "direct", "page", "above"])

    rows = pages.select("host", "html").mapInArrow(
        scan, "host string, node bigint, layout bigint, content bigint, chars bigint, direct bigint, page bigint, above array<bigint>")
    pairs = rows.dropDuplicates(["host", "node", "layout", "content", "page"]).groupBy("host", "node", "layout", "content").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("direct").alias("direct"), F.first("above").alias("above"))
    kinds = pairs.select("host", "node", "n", "chars", "direct", "above", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("layout").alias("value")), F.struct(F.lit(1).alias("kind"), F.col("content").alias("value"))
    )).alias("f")).select("host", "node", "n", "chars", "direct", "above", "f.kind", "f.value")
    counts = kinds.groupBy("host", "node", "kind", "value").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("direct").alias("direct"), F.first("above").alias("above"))
    log_m = F.log(F.sum("n").cast("double"))
    entropy = F.when(F.sum("n") > 1, (log_m - F.sum(F.col("n") * F.log(F.col("n").cast("double"))) / F.sum("n")) / log_m).otherwise(1.0)
    by_kind = counts.groupBy("host", "node", "kind").agg(
        entropy.alias("e"), F.sum("n").alias("m"), F.sum("chars").alias("chars"), F.sum("direct").alias("direct"), F.first("above").alias("above"))
    return by_kind.groupBy("host", "node").agg(
        F.max("m").alias("m"), F.max(F.when(F.col("kind") == 0, F.col("e"))).alias("layout"),
        F.max(F.when(F.col("kind") == 1, F.col("e"))).alias("content"), F.max("chars").alias("chars"), F.max("direct").alias("direct"),
        F.first("above").alias("above"))


def unimportant_nodes(pages: DataFrame, min_pages: int = MIN_PAGES, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """host, cut: the style nodes of low importance, on at least ``min_pages`` pages each.

    A node goes if its importance, the weighted entropy of content and layout, is low.  Outside the host's text, a node also
    goes if its layout alone is the same on (almost) all pages and it holds little.  The host's text is below a node with
    most of the host's characters whose own children are text blocks with a good part of them.
    """
    tree = stored(style_tree(pages), "style-tree")
    whole = tree.groupBy("host").agg(F.max("chars").alias("whole"))  # a root holds all of a host's text
    shares = tree.join(whole, "host")
    text = (F.col("chars") >= MOST * F.col("whole")) & (F.col("direct") >= TEXT_BLOCKS * F.col("whole"))
    # Nodes with most of a host's text lie above each other (or are two halves), so a host has at most some dozen.
    holders = shares.filter(text).groupBy("host").agg(F.collect_set("node").alias("holders"))
    beside = F.col("holders").isNotNull() & ~F.arrays_overlap(F.concat("above", F.array("node")), "holders")
    importance = CONTENT_WEIGHT * F.col("content") + (1 - CONTENT_WEIGHT) * F.col("layout")
    alike = beside & (F.col("layout") < MIN_LAYOUT) & (F.col("chars") < SMALL_BRANCH * F.col("whole"))
    low = shares.join(holders, "host", "left").filter((F.col("m") >= min_pages) & ((importance < min_importance) | alike))
    return low.groupBy("host").agg(F.collect_set("node").alias("cut"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text (empty if there is none), n_chars of every page.

    A null or empty html has no text.  Pages without a host (null or relative url) form one host.  Repeated rows are extracted
    each; no rows in, no rows out.
    """
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"),
                         host_of(url).alias("host"))
    # Written first: its size is known then, and a small table goes to the pages instead of the pages to it.
    cut = stored(unimportant_nodes(named), "style-tree")
    rows = named.join(cut, "host", "left").select("page_id", "url", "html", "cut")
    types = dict(rows.dtypes)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, set(nodes or ())) for page, nodes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(strip, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars bigint")
