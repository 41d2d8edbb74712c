"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of block elements with their classes. What a page shows
at a node counts by how many different pages of the host show the same there: shown by k of m pages, its content
importance is 1 - log_m(k), which is 1 for text of one page and 0 for text of all pages. A node's presentation
importance is the entropy, to base m, of the child sequences that its parent has on the host's pages. Branches whose
combined importance is low are menus, notices and other furniture, and are left out of each page. Pages with the same
main text count once, so copies of an article do not make it furniture; inside article and main, near copies count once too.

One page alone says nothing about its site, so elements that HTML itself or their names mark as furniture are left out too,
and where a page has ``article`` or ``main`` elements, the text is theirs.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.components import components
from ledgerloom.session import written

LEAST = 0.35  # importance below which a branch goes
CONTENT_SHARE = 0.9
MIN_PAGES = 4  # pages that a node must be on before its site says anything about it
MIN_PAGES_MARKED = 10  # the same inside article and main, where most pages must show it: near copies share blocks there
BANDS, BAND_ROWS = 8, 4  # pages of a host that agree in a band of their sketches are compared
LIKE = 20  # agreeing coordinates, of 32, from which two main texts are near copies
CHUNK = 1 << 14  # word pairs that are hashed at a time
FACTORS = np.random.default_rng(8).integers(0, 1 << 63, (BANDS * BAND_ROWS, 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html iframe legend li main menu nav noscript ol option optgroup p pre search section select summary svg table tbody td "
    "template textarea tfoot th thead title tr ul math".split()
)
FURNITURE = frozenset(
    "aside dialog fieldset footer head iframe menu nav noscript option select search svg template textarea title".split()
)
#: Elements whose content stands in for them: it goes with its end tag; without one only the start tag goes.
EMBEDDED = frozenset("audio video object canvas".split())
#: Elements that names and tags never mark: they hold the page, or its article.
HOLDERS = frozenset("html body main article".split())
LANDMARKS = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted promotion recommended related reply "
    "replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: What may follow the head of a class name, and what before it says that the thing is not there.
LAYOUT = frozenset("left right top bottom inner outer wrapper wrap container list area box block item section bar".split())
DENIED = frozenset("no not without has with hide".split())
#: A start tag of the first kind ends an open element of the second kinds.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
SCOPES = frozenset(("table", "ul", "ol", "dl", "select", "article", "main", "section", "div", "body", "html", "nav", "aside", "footer", "header", "td", "th"))
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<(?P<raw>script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def _hash(*parts: object) -> int:
    """A signed 64-bit number for the parts."""
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts))) - (1 << 63)


@dataclass
class _Node:
    tag: str
    path: int
    furniture: bool
    landmark: bool
    form: bool = False
    children: list[str] = field(default_factory=list)
    parent: _Node | None = None


@dataclass
class Block:
    node: _Node
    text: str


def _heads(value: str) -> set[str]:
    """What each class token or id names: its last word but layout words, as ``sidebar`` in ``left-sidebar`` or ``sidebar-inner``."""
    heads = set()
    for token in value.split():
        words = [w.lower() for w in NAME.findall(token)]
        while len(words) > 1 and words[-1] in LAYOUT:
            words.pop()
        if words and words[0] not in DENIED:
            heads.add(words[-1])
    return heads


def _furniture(tag: str, rest: str, parent: _Node) -> tuple[bool, str]:
    names = ""
    out = tag in FURNITURE or (tag == "header" and not parent.landmark)
    for name, *values in ATTRIBUTE.findall(rest) if rest.strip() else ():
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            out = True
        elif name == "role":
            out |= tag not in HOLDERS and value.strip().lower() in ROLES
        elif name in ("class", "id"):
            heads = _heads(value) if tag not in HOLDERS else set()
            out |= bool(heads & NAMES) or ("header" in heads and not parent.landmark)
            names += value if name == "class" else ""
    return out, names


def parse(page: str | None) -> list[Block]:
    """The page's non-empty text blocks in order. Tolerates unclosed, stray and cut-off tags."""
    root = _Node("", 0, False, False)
    stack, blocks, run = [root], [], []

    def flush() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                blocks.append(Block(stack[-1], text))
            run.clear()

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    page, at = page or "", 0
    for token in TOKEN.finditer(page):
        if token.start() < at:
            continue  # inside what stands in for an element
        if token.start() > at:
            run.append(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if tag == "br":
            run.append(" ")
        elif not token["end"] and (tag in EMBEDDED or (tag == "button" and not "".join(run).strip())):  # a button in a sentence is a word of it
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else at
        elif tag not in BLOCK:
            if token[0].startswith("<![CDATA["):
                run.append(entities.escape(token[0][9:-3]))
        elif token["end"]:
            found = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), None)
            close(found or len(stack))
        else:
            ends = CLOSES.get(tag, frozenset())
            while len(stack) > 1 and (stack[-1].tag in ends or stack[-1].tag == "p"):
                close(len(stack) - 1)
            if ends:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ends:
                        close(i)
                    if i < len(stack) and stack[i].tag in SCOPES:
                        break
            flush()
            parent = stack[-1]
            rest = token["rest"] or ""
            out, names = _furniture(tag, rest, parent)
            if not parent.children or parent.children[-1] != tag:  # runs of like children are one
                parent.children.append(tag)
            if tag not in VOID and not rest.rstrip().endswith("/"):
                landmark = parent.landmark or tag in LANDMARKS
                form = tag not in LANDMARKS and (tag == "form" or parent.form)
                stack.append(_Node(tag, _hash(parent.path, tag, names), out or parent.furniture, landmark, form, parent=parent))
    if at < len(page):
        run.append(page[at:])
    close(len(stack))
    return blocks


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def _shown(blocks: list[Block]) -> dict[int, tuple[int, int, bool]]:
    """At each node: the hash of all its text, the child sequence of its parent, and whether it is inside article or main."""
    texts: dict[int, list[str]] = {}
    nodes: dict[int, _Node] = {}
    for block in blocks:
        texts.setdefault(block.node.path, []).append(block.text)
        nodes[block.node.path] = block.node
    return {
        path: (_hash(path, *own), _hash(node.parent.path, *node.parent.children) if (node := nodes[path]).parent else 0, node.landmark)
        for path, own in texts.items()
    }


def _main(blocks: list[Block]) -> list[Block]:
    """The blocks that no tag or name marks, those of article and main if there are any. A form's go, unless the page is one form."""
    own = [b for b in blocks if not b.node.furniture]
    own = [b for b in own if not b.node.form] or own
    marked = [b for b in own if b.node.landmark]
    return marked or own


def _sketch(text: str) -> list[int] | None:
    """Least hashes of the text's word pairs; two texts agree in about as many as the share of pairs they have in common."""
    words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in text.split()), np.uint64)
    if not len(words):
        return None
    pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] if len(words) > 1 else words
    pairs ^= pairs >> np.uint64(29)
    least = np.minimum.reduce([(FACTORS * pairs[i : i + CHUNK]).min(1) for i in range(0, len(pairs), CHUNK)])
    return (least >> np.uint64(33)).astype(np.int32).tolist()


def _near_copies(sketches: DataFrame) -> DataFrame:
    """node and component of the pages (mark, host, sketch) that are near copies of others of their host."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64("host", i, F.slice("sketch", i * BAND_ROWS + 1, BAND_ROWS)))
    banded = sketches.select("mark", F.explode(bands).alias("band"))
    first = banded.groupBy("band").agg(F.min("mark").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = banded.join(first, "band").where("mark <> first").select("mark", "first").distinct()
    own, theirs = sketches.select("mark", "sketch"), sketches.select(F.col("mark").alias("first"), F.col("sketch").alias("other"))
    alike = F.size(F.filter(F.zip_with("sketch", "other", lambda a, b: a == b), lambda x: x)) >= LIKE
    links = met.join(own, "mark").join(theirs, "first").where(alike)
    return components(links.select(F.col("mark").alias("a"), F.col("first").alias("b")))


def style_tree(pages: DataFrame) -> DataFrame:
    """Content of low importance: host and ``low``, the hashes of (node, text) pairs that are furniture on that host."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                blocks, host = parse(page), host_of(url)
                main = _main(blocks)
                mark = _hash(host, *(b.text for b in main))
                rows += [(host, path, *shown, mark, None) for path, shown in _shown(blocks).items()]
                if main and main[0].node.landmark:  # a row of the page itself
                    rows.append((host, None, None, None, None, mark, _sketch(" ".join(b.text for b in main))))
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int32())]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["host", "path", "content", "style", "marked", "mark", "sketch"]
            )

    schema = "host string, path long, content long, style long, marked boolean, mark long, sketch array<int>"
    both = written(pages.select("url", "html").mapInArrow(nodes, schema).distinct(), "style-tree")
    copies = _near_copies(both.where("sketch IS NOT NULL").select("mark", "host", "sketch"))
    shown = both.where("path IS NOT NULL").drop("sketch")
    inside = shown.where("marked").join(copies, F.col("mark") == F.col("node"), "left").withColumn("mark", F.coalesce("component", "mark"))
    shown = written(shown.where("NOT marked").unionByName(inside.select(*shown.columns)).distinct(), "counted-once")
    node = ["host", "path"]
    pages_of = shown.select(*node, "marked", "mark").distinct().groupBy(*node).agg(F.count("*").alias("m"), F.bool_or("marked").alias("marked"))
    pages_of = pages_of.where(F.col("m") >= F.when(F.col("marked"), MIN_PAGES_MARKED).otherwise(MIN_PAGES))
    styles = shown.groupBy(*node, "style").agg(F.count("*").alias("k")).withColumn("m", F.sum("k").over(Window.partitionBy(*node)))
    share = F.col("k") / F.col("m")
    presentation = styles.groupBy(*node).agg(F.sum(-share * F.log(share) / F.log(F.greatest(F.col("m"), F.lit(2)).cast("double"))).alias("presentation"))
    contents = shown.select(*node, "content", "mark").distinct().groupBy(*node, "content").agg(F.count("*").alias("k")).where("k > 1")
    importance = CONTENT_SHARE * (1 - F.log(F.col("k").cast("double")) / F.log(F.col("m").cast("double"))) + (1 - CONTENT_SHARE) * F.col("presentation")
    low = contents.join(pages_of, node).join(presentation, node).where((importance < LEAST) & (~F.col("marked") | (F.col("k") * 2 > F.col("m"))))
    return low.groupBy("host").agg(F.collect_set("content").alias("low"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row; null html is empty, a null or odd url belongs to the host without a name. Extra columns are ignored."""
    low = written(style_tree(pages), "low-importance")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?i)[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host.alias("host")).join(low, "host", "left")

    def main_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, furniture in zip(batch.column("html").to_pylist(), batch.column("low").to_pylist(), strict=True):
                blocks = parse(page)
                if furniture:
                    drop = set(furniture)
                    gone = {path for path, (content, _, _) in _shown(blocks).items() if content in drop}
                    blocks = [b for b in blocks if b.node.path not in gone]
                texts.append(" ".join(b.text for b in _main(blocks)))
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.select("page_id", "url", "html", "low").mapInArrow(main_text, "page_id long, url string, text string")
