"""Main text of web pages, with site templates removed.

Pages are parsed into element trees. The subtree of every element of the page that can stand for itself is hashed
(names, classes and text), menus, footers and adverts among them; Spark counts on how many unlike pages of its host each
hash occurs, and subtrees that recur are deleted, wherever they stand. What is left gives the text: that of its articles,
else of main, else of the body. Menus, page headers and footers, sidebars, notices, adverts, forms and reader comments
that do not recur often enough, as on hosts with few pages, go by their names, roles and class or id words.

How often is enough depends on the kind of subtree (``RULES``): containers outside an article, and whatever is marked
so, go from few pages on; containers inside an article and text outside must recur on a larger share of the host's pages,
and whole pieces of text inside one (paragraphs, lists, tables, headers, figures) on half of them: a sentence that many
articles quote is no template. Headings, rows and items inside an article go only with what they are
part of. Pages with equal main text count once, so that copies of an article are no template of their host. A page that
would be left with nothing keeps its text.

The counts are aggregated map-side, so a host with a third of all pages is no hot key. At most ``BROADCAST_ROWS``
recurring hashes are sent to all tasks; beyond that pages are dealt by host and a salt for each ``SALTED`` pages of it,
and the host's hashes come before them in each such group. The parser is linear in a page's length, whatever its markup.

Null and empty html give an empty text. A page with a null url or no host has no host to compare with. Repeated rows
give repeated rows, an empty table an empty one. Very long pages are treated like any other, one at a time. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.plans.storage import materialize

CONTAINER, PIECE, TEXT = range(3)
#: For each kind of subtree: on how many unlike pages of a host and on what share of them it must occur to be a template.
RULES = {CONTAINER: (5, 0.001), PIECE: (20, 0.5), TEXT: (5, 0.1)}
#: Outside of articles, also what so many pages have, if these are nearly all of a small host's.
FEW, NEARLY_ALL = 3, 0.9
BROADCAST_ROWS = 100_000
#: Pages of a host that one group takes if pages have to be dealt.
SALTED = 20_000
#: Pages that are worked on at once.
RUN_PAGES = 500

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes template svg math".split())
GONE = frozenset("nav aside footer form button select datalist fieldset dialog menu head object audio video canvas".split()) | RAW
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
#: Elements whose repetition inside an article is not a template.
TEXTUAL = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup header li ul ol dir dt dd dl blockquote pre tr td th table thead tbody tfoot caption figure figcaption summary details".split()
)
#: Of these the ones that stand for themselves and go if very many articles share them; a heading, row or item is part of something.
PIECES = frozenset("p ul ol dl dir table header figure blockquote pre details".split())
#: What holds a page together is no subtree of it.
FRAME = frozenset(["", "html", "head", "body", "main", *VOID])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: An element that opens closes these, if they are open above the nearest other block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words of class and id attributes that mark what is no article.
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion sidebar sidenav nav navbar navigation menu"
    " menus breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay"
    " newsletter subscribe subscription signup login related recommended recommendations share sharing social comment comments commentlist"
    " disqus reply replies respond pagination pager toolbar masthead widget widgets banner skip".split()
)
PAGE_WORDS = frozenset("header topbar".split())

_name = re.compile(r"[a-zA-Z][^\s/>]*")
_stop = re.compile(r">|=\s*([\"'])")
_attribute = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_word = re.compile(r"[\s_-]+")
_raw_end = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}


class Node:
    """An element: name, class words, its children (nodes and strings) and whether it goes as no article."""

    __slots__ = ("name", "tag", "mark", "children", "gone", "inside")

    def __init__(self, name: str, mark: str, gone: bool, inside: bool) -> None:
        self.name = self.tag = name
        self.mark, self.gone, self.inside = mark, gone, inside
        self.children: list[Node | str] = []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _attribute.findall(text):
        found.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return found


class _Tags:
    """The tags of a page, in order. Every search goes on from where the last one ended or found nothing for good."""

    def __init__(self, html: str) -> None:
        self.html = html
        self.unclosed: set[str] = set()  # quotes that nothing closes any more

    def end(self, at: int) -> int:
        """Where the tag ends whose name ends at ``at``; -1 if nothing ends it. Quoted values may hold anything."""
        while found := _stop.search(self.html, at):
            if not found[1]:
                return found.end()
            at = found.end()
            if found[1] not in self.unclosed:
                close = self.html.find(found[1], at)
                if close < 0:
                    self.unclosed.add(found[1])
                else:
                    at = close + 1
        return -1

    def __iter__(self) -> Iterator[tuple[str, str, bool, str]]:
        """(text before, name in small letters, whether it closes, attributes); the last one has no name."""
        html, text, at = self.html, 0, 0
        while (at := html.find("<", at)) >= 0:
            closes = html.startswith("/", at + 1)
            name = _name.match(html, at + 1 + closes)
            if name:
                end = html.find(">", name.end()) + 1 if closes else self.end(name.end())
                if end <= 0:
                    break  # what nothing ends is text
                yield html[text:at], name[0].lower(), closes, html[name.end() : end - 1]
                if name[0].lower() in RAW and not closes:
                    found = _raw_end[name[0].lower()].search(html, end)
                    end = html.find(">", found.end()) + 1 if found else 0
                    end = end or len(html)
            elif html.startswith("!--", at + 1):
                yield html[text:at], "", True, ""
                end = html.find("-->", at + 4) + 3
                end = len(html) if end < 3 else end
            elif html.startswith(("!", "?", "/"), at + 1):
                end = html.find(">", at) + 1
                if end <= 0:
                    break
                yield html[text:at], "", True, ""
            else:
                at += 1
                continue
            text = at = end
        yield html[text:], "", False, ""


def parse(html: str) -> Node:
    """The tree of a page; whatever is unclosed is closed where its parent is."""
    root = Node("", "", False, False)
    stack = [root]
    opened: dict[str, int] = {}  # how many elements of a name are open
    walls: list[int] = []  # places in the stack of elements that ``CLOSES`` and paragraphs look at

    def shut(place: int) -> None:
        for node in stack[place:]:
            opened[node.tag] -= 1
        del stack[place:]
        while walls and walls[-1] >= place:
            walls.pop()

    for text, name, closes, attributes in _Tags(html):
        if text:
            stack[-1].children.append(text)
        if not name or (name in RAW and not closes):
            continue
        if closes:
            if opened.get(name):
                place = len(stack) - 1
                while stack[place].tag != name:
                    place -= 1
                shut(place)
            continue
        if name in VOID:
            stack[-1].children.append(Node(name, "", False, False))
            continue
        ends = CLOSES.get(name) or ({"p"} if name in BLOCK else None)
        if ends and any(opened.get(x) for x in ends):
            for place in reversed(walls):
                if stack[place].tag in ends:
                    shut(place)
                    break
                if stack[place].tag in BLOCK and stack[place].tag != "p":
                    break
        given = _attributes(attributes) if attributes.strip(" /") else {}
        parent = stack[-1]
        inside = parent.inside or name == "article"
        words = {w.lower() for w in _word.split(f"{given.get('class', '')} {given.get('id', '')}")}
        gone = name not in ("html", "body", "main") and (
            (name in GONE or (name == "header" and not parent.inside))
            or ("hidden" in given or given.get("aria-hidden") == "true" or given.get("role", "") in ROLES)
            or bool(words & WORDS and not (name == "article" and not parent.inside and "comment" not in words))
            or bool(words & PAGE_WORDS and not inside)
        )
        node = Node(name, f"{given.get('class', '')}#{given.get('id', '')}", gone, inside)
        if given.get("role") == "main":
            node.name = "main"
        parent.children.append(node)
        if name in BLOCK or name in ("td", "th", "option"):
            walls.append(len(stack))
        stack.append(node)
        opened[name] = opened.get(name, 0) + 1
    return root


def _find(node: Node, name: str) -> list[Node]:
    """The outermost elements of a name that are not gone."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if x.gone:
            continue
        if x.name == name:
            out.append(x)
        else:
            todo += [c for c in reversed(x.children) if isinstance(c, Node)]
    return out


def parts(root: Node) -> list[Node]:
    """Where the text is: the articles, else main, else the body, else everything."""
    for name in ("article", "main", "body"):
        if found := _find(root, name):
            return found
    return [root]


def digests(root: Node) -> list[tuple[Node, int]]:
    """The elements of a page that may be templates, with the hashes of their subtrees: 64 bits, signed, the last two its kind."""
    nodes, todo = [], [root]
    while todo:
        x = todo.pop()
        nodes.append(x)
        todo += [c for c in reversed(x.children) if isinstance(c, Node)]
    whole: dict[int, bytes] = {}
    out = []
    for node in reversed(nodes):
        taken = hashlib.blake2b(f"{node.name} {node.mark}\0".encode("utf-8", "surrogatepass"), digest_size=8)
        for child in node.children:
            taken.update(b"\1" + whole.get(id(child), b"") if isinstance(child, Node) else b"\2" + " ".join(unescape(child).split()).encode("utf-8", "surrogatepass"))
        whole[id(node)] = taken.digest()
        if node.name in FRAME or not (node.gone or node.name in BLOCK):
            continue
        if node.gone or not (node.inside or node.name in TEXTUAL):
            kind = CONTAINER
        elif not node.inside or node.name not in TEXTUAL:
            kind = TEXT
        elif node.name in PIECES:
            kind = PIECE
        else:
            continue
        out.append((node, (int.from_bytes(whole[id(node)], "big", signed=True) & ~3 | kind) or 4))
    return out


def blocks(part: Node) -> list[str]:
    """The blocks of text of a part, without what is gone."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := " ".join(unescape("".join(held)).split()):
            out.append(text)
        held.clear()

    todo: list[tuple[Node | str | None, bool]] = [(part, False)]
    while todo:
        x, headings = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            if not headings:
                held.append(x)
        elif not x.gone:
            if x.name in ("br", "td", "th"):
                held.append(" ")
            if x.name in BLOCK:
                flush()
                todo.append((None, False))
            only = (headings or x.name == "header") and x.name not in HEADINGS  # of an article's header its headings stay
            todo += [(c, only) for c in reversed(x.children)]
    flush()
    return out


def _text(root: Node) -> str:
    return "\n\n".join(b for part in parts(root) for b in blocks(part))


def extract(html: str, templates: frozenset[int] = frozenset()) -> str:
    """The main text of a page: its blocks, joined by empty lines, without subtrees whose hash is in ``templates``."""
    root = parse(html)
    found = [node for node, digest in digests(root) if digest in templates] if templates else []
    marked = [node for node in found if not node.gone]
    for node in marked:
        node.gone = True
    text = _text(root)
    if text or not marked:
        return text
    for node in marked:
        node.gone = False
    return _text(root)


def host(url: Column) -> Column:
    """The host of a url, in small letters; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit(""))


def site_templates(pages: DataFrame) -> DataFrame:
    """(host, hash, pages) of the subtrees that recur on a host; ``pages`` is how many unlike pages it has."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, RUN_PAGES):
                part = batch.slice(begin, RUN_PAGES)
                hosts, hashes, texts = [], [], []
                for name, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    root = parse(html or "")
                    own = {digest for _, digest in digests(root)}
                    whole = hashlib.blake2b(_text(root).encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    hosts += [name] * (len(own) + 1)
                    hashes += [0, *own]  # 0 counts the pages
                    texts += [int.from_bytes(whole, "big", signed=True)] * (len(own) + 1)
                columns = [pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(texts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["host", "hash", "page"])

    seen = pages.select(host(F.col("url")).alias("host"), "html").where("host <> ''").mapInArrow(hashed, "host string, hash long, page long")
    distinct = seen.distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts, _ = materialize(distinct.where(f"hash = 0 or n >= {FEW}"), "subtrees")
    total = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    kind = F.col("hash").bitwiseAND(F.lit(3))
    enough = F.lit(False)
    for number, (least, share) in RULES.items():
        enough = enough | ((kind == number) & (F.col("n") >= least) & (F.col("n") >= F.col("pages") * share))
    enough = enough | ((kind != PIECE) & (F.col("n") >= FEW) & (F.col("n") >= F.col("pages") * NEARLY_ALL))
    return counts.where("hash <> 0").join(total, "host").where(enough).select("host", "hash", "pages")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    found, _ = materialize(site_templates(pages), "templates")
    kind = pages.schema["page_id"].dataType.simpleString()
    named = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        texts = named.mapInArrow(_extractor(_known(found)), f"page_id {kind}, url string, text string")
    else:
        dealt = _dealt(named, found).select("page_id", "url", "html", "host", "hash")
        texts = dealt.mapInArrow(_extractor(None), f"page_id {kind}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def _known(found: DataFrame) -> dict[str, frozenset[int]]:
    """The recurring hashes by host, at most ``BROADCAST_ROWS`` in all."""
    known: dict[str, set[int]] = {}
    for row in found.select("host", "hash").collect():
        known.setdefault(row.host, set()).add(row.hash)
    return {name: frozenset(hashes) for name, hashes in known.items()}


def _dealt(named: DataFrame, found: DataFrame) -> DataFrame:
    """Pages and templates by host and salt, the templates (with a ``hash``) before the pages of each such group."""
    wide = found.groupBy("host").agg(F.ceil(F.max("pages") / SALTED).cast("int").alias("salts"))
    large = F.broadcast(wide.where("salts > 1"))  # at most a row for each SALTED pages
    salted = named.join(large, "host", "left")
    spread = F.when(F.col("host") == "", 4096).otherwise(F.coalesce("salts", F.lit(1)))  # pages without a host have no templates
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("html"), spread).cast("int"))
    every = found.join(wide, "host").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("host", "hash", "salt")
    both = salted.drop("salts").unionByName(every, allowMissingColumns=True)
    return both.repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("hash").asc_nulls_last())


def _extractor(known: dict[str, frozenset[int]] | None):
    """Takes pages to their texts; without ``known`` the templates of a host are the rows before its pages."""

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, listed, templates = None, set(), frozenset()
        for batch in batches:
            for begin in range(0, batch.num_rows, RUN_PAGES):
                part = batch.slice(begin, RUN_PAGES)
                hosts, pages = part.column("host").to_pylist(), part.column("html").to_pylist()
                hashes = [None] * len(hosts) if known is not None else part.column("hash").to_pylist()
                texts, kept = [], []
                for at, (name, html, digest) in enumerate(zip(hosts, pages, hashes, strict=True)):
                    if known is not None:
                        templates = known.get(name, frozenset())
                    elif name != current:
                        current, listed, templates = name, set(), None
                    if digest is not None:
                        listed.add(digest)
                        templates = None
                        continue
                    if templates is None:
                        templates = frozenset(listed)
                    kept.append(at)
                    texts.append(extract(html, templates) if html else "")
                own = part.take(pa.array(kept, pa.int64())) if len(kept) < len(hosts) else part
                yield pa.RecordBatch.from_arrays([own.column("page_id"), own.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return extracted
