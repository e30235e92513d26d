"""Main text of web pages: the template of a site is what recurs on many of its pages.

Each page is parsed into elements. Every element outside the page's main part gets a hash of its whole subtree (tag,
class, id, text, children). Spark counts, for each host, the different pages that hold each hash; subtrees on TEMPLATE_PAGES
pages and more are deleted. So are elements whose tag, role, class or id names them as furniture (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, reader comments): a host of few pages repeats nothing. All other text stays.

The main part is what a page marks as such (article, else main); where none is marked, the element that itself holds most
text outside links. Recurrence is no evidence against it, since articles are copied and quoted: inside, only furniture
goes. Exact copies of a page count as one page.

Pages are parsed twice, so that only hashes (some 40 bytes an element) are shuffled for the counts. What is to be deleted
is joined to a page's pieces of text by a hash of the page; two pages that share it can only share deletions that hold for
their host anyway. No host, subtree or group of copies is gathered in one task.

Text: character references are decoded as browsers do (`&amp` too); runs of Unicode white space, line breaks (br)
included, become one space; blocks are trimmed, empty ones left out, the others joined by line ends in page order. A table
cell, list item or heading is a block; inline elements are not.

Defined results: null html is empty; text outside any element counts as body text; a null url, or one without a host, is a
host of its own ('' for all of them); repeated rows each get a row; markup that is broken is read as browsers read it
(unclosed p, li and cells end where the next begins; stray end tags count for nothing; an unclosed script, style or comment
runs to the end); very long pages are read whole, in linear time; extra columns, clashing ones too, play no part; an empty
table gives an empty table.
"""

from __future__ import annotations

import html as references
import json
import re
from collections import Counter
from itertools import groupby

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_fold, arrow_map, cut, only

#: A subtree on so many different pages of a host is template.
TEMPLATE_PAGES = 3
#: Level of zstd at which the texts of a page travel.
PACKED = 9
#: Elements nest so deep; those further in lie side by side in the deepest, with all their text (browsers have such a bound too).
DEPTH = 512

# Names of HTML, in natural order.
_VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: tag -> (tags that it ends, where the search for them stops)
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "body"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "body"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "body"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table", "body"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table", "body"])),
    "tr": (frozenset(["tr"]), frozenset(["table", "body"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table", "body"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot"]), frozenset(["table", "body"])),
    "option": (frozenset(["option"]), frozenset(["select", "body"])),
}
#: Elements whose text counts for what holds them.
_PARTS = frozenset("blockquote h1 h2 h3 h4 h5 h6 li p pre tbody td tr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_P_SCOPE = frozenset("body button caption table td th".split())
_NO_TEXT = frozenset("audio button canvas datalist dialog embed head iframe input map noembed noframes noscript object option script select style svg template textarea title video".split())
_FURNITURE_TAGS = frozenset("aside footer form header menu nav".split())
_FURNITURE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words of class and id.
_FURNITURE_WORDS = frozenset(
    "ad ads adsense adsbygoogle advert advertisement advertising adverts banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies copyright disqus "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies respond share sharing sidebar signup social sponsor sponsored subscribe widget".split()
)

_TAG = re.compile(r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/[^a-zA-Z][^>]*>|/>|(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]|=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+)?+)*+)>)""", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[A-Za-z0-9]+")
_HOST = re.compile(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


class _Element:
    __slots__ = ("children", "depth", "furniture", "inside", "main", "marks", "parent", "tag", "weight")

    def __init__(self, tag, marks, parent, furniture, main):
        self.tag, self.marks, self.parent, self.furniture, self.main = tag, marks, parent, furniture, main
        self.children, self.weight, self.inside = [], 0, False
        self.depth = parent.depth + 1 if parent is not None else 0


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _marks(attrs: str) -> dict[str, str]:
    return {m[1].lower(): references.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)} if attrs.strip(" /\t\n\r\f") else {}


def _is_furniture(tag: str, marks: dict[str, str]) -> bool:
    if tag in _FURNITURE_TAGS or "hidden" in marks or marks.get("role", "").lower() in _FURNITURE_ROLES:
        return True
    if tag in ("html", "body", "article", "main"):  # their classes tell of the page
        return "comment" in _WORD.findall(marks.get("class", "").lower())
    return any(w in _FURNITURE_WORDS for k in ("class", "id") if k in marks for w in _WORD.findall(marks[k].lower()))


def parse(text: str) -> _Element:
    """The tree of a page; children are elements and strings. Subtrees without readable text (scripts) are left out."""
    root = here = _Element("body", {}, None, False, None)
    at, end = 0, len(text)
    beyond: list[str] = []  # open elements that would lie deeper than DEPTH
    n_beyond: Counter = Counter()
    while at < end:
        lt = text.find("<", at)
        if lt < 0:
            here.children.append(text[at:])
            break
        if lt > at:
            here.children.append(text[at:lt])
        m = _TAG.match(text, lt)
        if m is None:
            if text[lt + 1 : lt + 2].isalpha() or text[lt + 1 : lt + 2] == "/":  # a tag that the page's end cuts off
                break
            here.children.append("<")
            at = lt + 1
            continue
        at, tag = m.end(), m["name"]
        if tag is None:
            continue
        tag, attrs = tag.lower(), m["attrs"]
        if m["close"]:
            if n_beyond[tag]:
                while True:
                    last = beyond.pop()
                    n_beyond[last] -= 1
                    if last == tag:
                        break
                continue
            e = here
            while e is not None and e.tag != tag:
                e = e.parent
            if e is not None and e.parent is not None:
                here = e.parent
                beyond.clear()
                n_beyond.clear()
            continue
        if tag in ("html", "body"):
            continue
        if tag in _ENDS_P:
            e = here
            while e is not None and e.tag not in _P_SCOPE:
                if e.tag == "p":
                    here = e.parent
                    break
                e = e.parent
        ends = _ENDS.get(tag)
        if ends:
            e = here
            while e is not None and e.tag not in ends[1]:
                if e.tag in ends[0]:
                    here = e.parent
                    break
                e = e.parent
        if tag in _RAW:
            close = _RAW_END[tag].search(text, at)
            if close is None:
                break
            at = text.find(">", close.end())
            at = end if at < 0 else at + 1
            continue
        marks = _marks(attrs)
        if tag in ("article", "main") or marks.get("role") == "main":
            main = "article" if tag == "article" else "main"
        else:
            main = None
        e = _Element(tag, marks, here, _is_furniture(tag, marks), main)
        here.children.append(e)
        if tag in _VOID:
            continue
        if here.depth < DEPTH:
            here = e
        else:
            beyond.append(tag)
            n_beyond[tag] += 1
    return root


def find_main(root: _Element) -> list[_Element]:
    """The main parts: outermost articles outside furniture, else outermost main elements, else the element that itself
    (or in its paragraphs) holds most text outside links and furniture."""
    found: dict[str, list[_Element]] = {"article": [], "main": []}
    weights: list[_Element] = []
    stack = [(root, False, False, root, None)]
    while stack:
        e, linked, formed, holder, within = stack.pop()
        if e.tag in _NO_TEXT or (e.furniture and e.tag != "form"):
            continue
        if e.main and within != "article" and e.main != within:
            found[e.main].append(e)
            within = e.main
        linked, formed = linked or e.tag == "a", formed or e.tag == "form"  # a form may hold the whole page
        holder = holder if e.tag in _INLINE or e.tag in _PARTS else e
        for c in e.children:
            if type(c) is not str:
                stack.append((c, linked, formed, holder, within))
            elif not linked and not formed:
                if not holder.weight:
                    weights.append(holder)
                holder.weight += len(c.strip())
    return found["article"] or found["main"] or ([max(weights, key=lambda w: w.weight)] if weights else [])


def _clean(text: str) -> str:
    return " ".join((references.unescape(text) if "&" in text else text).split())


def pieces(text: str) -> list[tuple[str, bool, int | None]]:
    """Blocks of text in page order: (text, in furniture, hash of the innermost subtree around it that may be template).

    Where an outer subtree recurs, so do all within it on the same pages; the innermost one is all that counts."""
    root = parse(text)
    mains = find_main(root)
    for e in mains:
        while e is not None:  # what holds the main part is neither template nor furniture
            e.inside = True
            e = e.parent
    kept = set(map(id, mains))
    blocks: list[tuple[str, bool, int | None]] = []
    hashes: list[int] = []
    run: list[str] = []
    open_: list[tuple[int, xxhash.xxh64]] = []  # subtrees that may be template, around the place in the page
    furniture = False

    def flush():
        said = _clean("".join(run))
        run.clear()
        if said:
            blocks.append((said, furniture, open_[-1][0] if open_ else None))
            if open_:
                open_[-1][1].update(f"\0{said}")

    stack: list = [(root, False)]  # no recursion: pages nest as deep as they like
    while stack:
        at = stack.pop()
        if type(at) is str:
            run.append(at)
            continue
        if len(at) == 3:  # leave an element
            block, hashed, before = at
            if block:
                flush()
            if hashed:
                slot, h = open_.pop()
                hashes[slot] = int(np.uint64(h.intdigest()).astype(np.int64))
                if open_:
                    open_[-1][1].update(b"\1" + h.digest())
            furniture = before
            continue
        e, main = at
        if e.tag == "br":
            run.append(" ")
        if e.tag in _NO_TEXT or (e.tag in _VOID and e.tag != "hr"):
            continue
        block = e.tag not in _INLINE
        if block:
            flush()
        main = main or id(e) in kept
        named = e.furniture and not e.inside
        if named and main and e.tag == "header" and any(type(c) is not str and c.tag in _HEADINGS for c in e.children):
            named = False  # the heading of the article itself
        hashed = block and not main and not e.inside
        stack.append((block, hashed, furniture))
        furniture = furniture or named
        if hashed:
            open_.append((len(hashes), xxhash.xxh64(f"{e.tag}\0{e.marks.get('class', '')}\0{e.marks.get('id', '')}")))
            hashes.append(0)
        stack.extend(c if type(c) is str else (c, main) for c in reversed(e.children))
    flush()
    return [(said, f, None if slot is None else hashes[slot]) for said, f, slot in blocks]


def _keyed(pages: DataFrame) -> DataFrame:
    p = only(pages, "page_id", "url", "html")
    return p.withColumn("page", F.xxhash64(F.col("page_id"), F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))


def subtrees(pages: DataFrame) -> DataFrame:
    """(page, copy, host, subtree): hashes of the elements of each page that may be template; equal pages share `copy`."""
    long = T.LongType()
    schema = T.StructType([T.StructField("page", long), T.StructField("copy", long), T.StructField("host", T.StringType()), T.StructField("subtree", long)])
    slim = _keyed(pages).select("page", F.xxhash64(F.coalesce("html", F.lit(""))).alias("copy"), "url", "html")

    def run(batches):
        for b in batches:
            out = ([], [], [], [])
            for page, copy, url, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                found = {h for _, _, h in pieces(text or "") if h is not None}
                out[0].extend([page] * len(found))
                out[1].extend([copy] * len(found))
                out[2].extend([host_of(url)] * len(found))
                out[3].extend(found)
            yield dict(zip(schema.names, out))

    return arrow_fold(slim, run, schema)


def templates(found: DataFrame, least: int = TEMPLATE_PAGES) -> DataFrame:
    """(host, subtree, n_pages) of subtrees that recur on at least so many different pages of a host."""
    each = found.select("host", "subtree", "copy").distinct()
    return each.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n_pages")).filter(F.col("n_pages") >= least)


def extract(pages: DataFrame, least: int = TEMPLATE_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars, n_template, n_furniture); the last two count runs of blocks deleted as template, and as furniture alone."""
    found = cut(subtrees(pages))
    recurs = templates(found, least).select(F.col("host").alias("t_host"), F.col("subtree").alias("t_subtree"))
    gone = found.join(recurs, (F.col("host") == F.col("t_host")) & (F.col("subtree") == F.col("t_subtree"))).groupBy(F.col("page").alias("g_page")).agg(F.collect_set("subtree").alias("gone"))
    keyed = _keyed(pages)
    long = T.LongType()
    block = T.StructType([T.StructField("furniture", T.BooleanType()), T.StructField("subtree", long)])
    names = [keyed.schema["page_id"], keyed.schema["url"]]
    schema = T.StructType([*names, T.StructField("page", long), T.StructField("blocks", T.ArrayType(block)), T.StructField("texts", T.BinaryType())])

    def told(b):
        pack = zstandard.ZstdCompressor(level=PACKED)
        ids, urls, htmls, keys = (b.column(i).to_pylist() for i in range(4))
        blocks, texts = [], []
        for text in htmls:  # neighbours that share their fate travel as one; furniture without its text
            runs = [(f, h, "\n".join(x[0] for x in mine)) for (f, h), mine in groupby(pieces(text or ""), key=lambda x: x[1:])]
            blocks.append([{"furniture": f, "subtree": h} for f, h, _ in runs])
            texts.append(pack.compress(json.dumps(["" if f else t for f, _, t in runs], ensure_ascii=False).encode()))
        yield {"page_id": ids, "url": urls, "page": keys, "blocks": blocks, "texts": texts}

    def kept(b):
        unpack = zstandard.ZstdDecompressor()
        out = ([], [], [])
        for blocks, texts, deleted in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
            recurring = [x["subtree"] in (deleted or ()) for x in blocks]
            stays = [t for t, x, r in zip(json.loads(unpack.decompress(texts)), blocks, recurring) if not r and not x["furniture"]]
            out[0].append("\n".join(stays))
            out[1].append(sum(recurring))
            out[2].append(sum(x["furniture"] and not r for x, r in zip(blocks, recurring)))
        yield {"page_id": b.column(0), "url": b.column(1), "text": out[0], "n_chars": [len(t) for t in out[0]], "n_template": out[1], "n_furniture": out[2]}

    joined = arrow_map(keyed.select("page_id", "url", "html", "page"), told, schema).join(gone, F.col("page") == F.col("g_page"), "left").select("page_id", "url", "blocks", "texts", "gone")
    return arrow_map(joined, kept, T.StructType([*names, T.StructField("text", T.StringType()), *(T.StructField(c, long) for c in ("n_chars", "n_template", "n_furniture"))]))
