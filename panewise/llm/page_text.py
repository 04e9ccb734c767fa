"""Main text of web pages: what a site repeats on its pages is taken off, then what is no article.

Every element is hashed with all that is below it: names of elements and text, not attributes.
Spark counts, per host, in how many different surroundings (elements around it) such a subtree
stands. One that recurs in ``MIN_PLACES`` of them, and in as many as ``MIN_SHARE`` of the host's
pages, is part of the site's template and is deleted from every page of the host. Counting
surroundings instead of pages keeps the text of an article that the host shows at many addresses:
there it always stands in the same surroundings. Neither ``article`` and ``main`` themselves nor
the paragraphs, headings and list items in them are ever taken for a template.

What a small host repeats too seldom is found by rules: elements whose name or role says what they
are (navigation, footer, aside, form, script ...), whose class or id has a word such as ``sidebar``
or ``comments``, or that are hidden. If a page has an ``article`` or ``main``, only that counts.

Pages are read twice, since hashes are small and pages are not: the first time for the hashes, the
second time for the text, which is shuffled once, to meet the page's deleted subtrees. A subtree
that a very large host has on all of its pages is a hot key on one side only, which Spark splits.

Null and empty pages have an empty text. A null address, or one without a host, has no template.
Pages may be cut off anywhere, nested to any depth (elements below ``DEPTH`` count as text of the
one around them) and of any length: reading is linear in it. Repeated rows each get their row, and
further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored

MIN_PLACES = 3
MIN_SHARE = 0.001
DEPTH = 512

# Elements that flow with the text around them; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q ruby rb rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea select title".split())
# Without an end tag, these go on to the end of the page.
ENDLESS = frozenset("script style textarea title".split())
# Starting one of these ends an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul li dd dt".split()
)
# Starting one of these ends an open one of the second set, unless one of the third lies between.
REPLACES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "p": ({"p"}, {"td", "th", "table"}),
}
MAIN = frozenset({"article", "main"})
# Elements of a main part that may still be template; paragraphs and the like there never are.
CONTAINERS = frozenset("div section aside ul ol dl nav header footer form fieldset figure table details center menu".split())

NOT_TEXT = frozenset("nav footer aside form button dialog menu head label fieldset".split())
NOT_TEXT_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar toolbar".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar widget widgets footer header masthead topbar cookie cookies consent gdpr notice alert popup "
    "modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies share sharing "
    "social related recommended recommendations pagination pager toolbar searchform outbrain taboola".split()
)
# The head of an article holds its title; a word such as "with" tells of another element.
OWN_HEAD = frozenset("article entry post story content".split())
TELLS_OF_OTHERS = frozenset("has with no without".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>""")
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|hidden|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ENDS = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}


def is_not_text(tag: str, attributes: str, in_main: bool) -> bool | None:
    """What the rules say of an element by itself: True, False, or None if only its words speak against it."""
    if tag in NOT_TEXT or (tag == "header" and not in_main):
        return True
    if not attributes:
        return False
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            return True
        if name == "role" and value.lower() in NOT_TEXT_ROLES:
            return True
        if name in ("class", "id"):
            for part in value.split():
                found = {word.lower() for word in _WORD.findall(part)}
                if "header" in found and found & OWN_HEAD:
                    found.discard("header")
                words |= set() if found & TELLS_OF_OTHERS else found
    return None if words & NOT_TEXT_WORDS else False


class Page:
    """The elements and text blocks of one page. Element 0 holds the whole page."""

    def __init__(self, html: str) -> None:
        self.tags, self.above, self.attributes = [""], [-1], [""]
        self.digests = [0]
        self.has_text = [False]
        self.blocks: list[tuple[str, int]] = []  # normalised text, element
        self._stack, self._open = [0], Counter()
        self._parts: list[list[bytes]] = [[]]  # of the open elements
        self._text: list[str] = []
        self._endless: set[str] = set()
        self._read(html)
        while self._stack:
            self._close()

    def _read(self, html: str) -> None:
        at, tag = 0, _TAG
        while True:
            start = html.find("<", at)
            if start < 0:
                self._text.append(html[at:])
                return
            if start > at:
                self._text.append(html[at:start])
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                if end < 0:
                    return
                at = end + 3
                continue
            if html.startswith(("<!", "<?"), start):
                end = html.find(">", start)
                if end < 0:
                    return
                at = end + 1
                continue
            if not re.match(r"</?[A-Za-z]", html[start : start + 3]):
                self._text.append("<")
                at = start + 1
                continue
            found = tag.match(html, start)
            if found is None and tag is _TAG:
                tag = _PLAIN_TAG  # a quotation mark is open to the end: from here on they count for nothing
                found = tag.match(html, start)
            if found is None:
                return
            at = found.end()
            name = found[2].lower()
            if found[1]:
                self._end(name)
                continue
            if name in RAW:
                self._text.append(" ")
                closing = None if found[3].endswith("/") or name in self._endless else _ENDS[name].search(html, at)
                if closing is not None:
                    at = html.find(">", closing.start()) + 1 or len(html)
                elif name in ENDLESS:
                    return
                elif not found[3].endswith("/"):
                    self._endless.add(name)  # without an end further on, it is looked for only once
                continue
            self._start(name, found[3])

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text.append(" ")
        if name in INLINE or name in VOID and name != "hr":
            return
        if name in ENDS_PARAGRAPH:
            self._end_nearest(*REPLACES["p"])
        if name in REPLACES:
            self._end_nearest(*REPLACES[name])
        self._flush()
        if name == "hr" or len(self._stack) > DEPTH:
            return
        self._stack.append(len(self.tags))
        self._parts.append([name.encode()])
        self._open[name] += 1
        self.tags.append(name)
        self.above.append(self._stack[-2])
        self.attributes.append(attributes)
        self.digests.append(0)
        self.has_text.append(False)

    def _end_nearest(self, names: set[str], bounds: set[str]) -> None:
        if any(self._open[name] for name in names):
            for place in range(len(self._stack) - 1, 0, -1):
                tag = self.tags[self._stack[place]]
                if tag in names:
                    while len(self._stack) > place:
                        self._close()
                    return
                if tag in bounds:
                    return

    def _end(self, name: str) -> None:
        if name in INLINE:
            return
        if name in REPLACES:
            self._end_nearest({name}, REPLACES[name][1])
        elif self._open[name]:
            while self.tags[self._stack[-1]] != name:
                self._close()
            self._close()
        self._flush()

    def _flush(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            self._text = []
            if text:
                self._parts[-1].append(text.encode("utf-8", "replace"))
                self.has_text[self._stack[-1]] = True
                self.blocks.append((text, self._stack[-1]))

    def _close(self) -> None:
        from xxhash import xxh64_digest, xxh64_intdigest

        self._flush()
        element, parts = self._stack.pop(), b"\0".join(self._parts.pop())
        self.digests[element] = xxh64_intdigest(parts)
        if self._stack:
            self._open[self.tags[element]] -= 1
            self._parts[-1].append(b"\1" + xxh64_digest(parts))
            self.has_text[self._stack[-1]] |= self.has_text[element]

    def judged(self) -> tuple[list[bool], list[bool]]:
        """Per element: whether the rules leave it, and whether it may be part of a template."""
        count = len(self.tags)
        main = [tag in MAIN or 'role="main"' in self.attributes[e] for e, tag in enumerate(self.tags)]
        holds_main, holds_head = main[:], [tag == "h1" for tag in self.tags]
        for element in range(count - 1, 0, -1):
            holds_main[self.above[element]] |= holds_main[element]
            holds_head[self.above[element]] |= holds_head[element]
        kept, in_main, may_repeat = [True] * count, [False] * count, [False] * count
        for element in range(1, count):
            above, tag = self.above[element], self.tags[element]
            says = is_not_text(tag, self.attributes[element], in_main[above])
            whole = tag in ("html", "body", "main") or (holds_main[element] and holds_head[element])
            kept[element] = kept[above] and not (says or (says is None and not whole))
            in_main[element] = in_main[above] or (main[element] and kept[element])
            may_repeat[element] = not (
                tag in ("html", "body") or holds_main[element] or (in_main[element] and tag not in CONTAINERS)
            )
        if any(in_main):
            kept = [a and b for a, b in zip(kept, in_main, strict=True)]
        return kept, may_repeat


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, host, hash, around): the subtrees of each page that may be template, and the element around each."""
    for batch in batches:
        keys, hosts, hashes, around = [], [], [], []
        for key, host, html in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            page = Page(html or "")
            may_repeat = page.judged()[1]
            found = {
                (page.digests[e], page.digests[page.above[e]])
                for e in range(1, len(page.tags))
                if may_repeat[e] and page.has_text[e]
            }
            for digest, outer in found:
                keys.append(key)
                hosts.append(host)
                hashes.append(digest)
                around.append(outer)
        yield pa.record_batch(
            [pa.array(keys, pa.string()), pa.array(hosts, pa.string()), pa.array(_signed(hashes)), pa.array(_signed(around))],
            names=["key", "host", "hash", "around"],
        )


BLOCKS = "array<struct<text:string,within:array<bigint>>>"


def _blocks(rules: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("within", pa.list_(pa.int64()))]))
        for batch in batches:
            texts = []
            for html in batch.column(batch.num_columns - 1).to_pylist():
                page = Page(html or "")
                kept, may_repeat = page.judged()
                held: list[list[int]] = [[]]  # per element: the hashes of it and those around it that may be template
                for element in range(1, len(page.tags)):
                    outer = held[page.above[element]]
                    digest = page.digests[element]
                    held.append([*outer, digest - (1 << 64) if digest >> 63 else digest] if may_repeat[element] else outer)
                texts.append([{"text": t, "within": held[e]} for t, e in page.blocks if kept[e] or not rules])
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.record_batch([*columns, pa.array(texts, kind)], names=["key", "page_id", "url", "blocks"])

    return run


def host_of(url: Column) -> Column:
    """The host of an address, in lower case; empty if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)", 1)
    return F.coalesce(found, F.lit(""))


def template_subtrees(subtrees: DataFrame, pages: DataFrame, min_places: int, min_share: float) -> DataFrame:
    """(host, hash): the subtrees that recur over a host's pages. ``pages`` has (host)."""
    places = (
        subtrees.select("host", "hash", "around").distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("places"))
    )
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    recurring = places.where(F.col("places") >= min_places).join(sizes, "host")
    return recurring.where(F.col("places") >= F.col("pages") * min_share).select("host", "hash")


def page_text(
    pages: DataFrame, min_places: int = MIN_PLACES, min_share: float = MIN_SHARE, templates: bool = True, rules: bool = True
) -> DataFrame:
    """(page_id, url, text): the main text of every page, its blocks joined by line ends.

    Either part of the method can be left out, to see what the other does.
    """
    # Equal rows have one key, and get the same text.
    key = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.xxhash64("url", "html").cast("string"))
    keyed = pages.select(key.alias("key"), host_of(F.col("url")).alias("host"), "page_id", "url", "html")
    cut = keyed.select("key", "page_id", "url", "html").mapInArrow(
        _blocks(rules), f"key string, page_id {pages.schema['page_id'].dataType.simpleString()}, url string, blocks {BLOCKS}"
    )
    blocks = F.col("blocks")
    if templates:
        hosted = keyed.where("host <> ''")
        subtrees = stored(
            hosted.select("key", "host", "html").mapInArrow(_subtrees, "key string, host string, hash bigint, around bigint"),
            "subtrees",
        )
        repeated = stored(template_subtrees(subtrees, hosted.select("host"), min_places, min_share), "templates")
        gone = subtrees.join(repeated, ["host", "hash"]).groupBy("key").agg(F.collect_set("hash").alias("gone"))
        cut = cut.join(gone, "key", "left")
        nothing = F.array().cast("array<bigint>")
        blocks = F.filter(blocks, lambda b: ~F.arrays_overlap(b["within"], F.coalesce("gone", nothing)))
    return cut.select("page_id", "url", F.array_join(F.transform(blocks, lambda b: b["text"]), "\n").alias("text"))
