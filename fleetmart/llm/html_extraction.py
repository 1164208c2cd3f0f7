"""Main text of web pages, less the template that a host's pages share.

A page is read as tokens: tags with the path of open elements, and blocks of text (inline tags don't end a block). The
template of a host comes from equivalence classes: tokens with the same occurrence vector, that is the same number of
occurrences on every page of the host, were written by the same part of the template. A class is valid if it occurs on
at least ``LEAST_PAGES`` different pages and holds a tag of its own; a text that many articles quote has no tag that
comes and goes with it. Classes nest as their tags' elements do. What the template leaves open are its slots; the text
is that of the slots inside the article (where a page has one, or else of the page), outside menus, headers, footers,
sidebars, notices, adverts, forms and comments, which are told by element, role and class. A form around an article,
or around all text of the page, is no form to be filled in: what it holds stays. A class or id counts as a
whole (``cookie-notice`` is one, ``no-header`` isn't), and none tells of an article, a main element, what holds them, or
the headings and paragraphs inside; sections inside are left to the template unless named as comments, adverts and such.

Pages that mark no article are cut by the sums of their host, over its different pages, by place in the template: a slot
most of whose text is linked, over all pages, is a menu, whatever a single page has there, and one that is mostly not
linked is text. The content of a page is the deepest element, once a page, whose inner elements hold more than half of
the unlinked text of the pages that it is on; a slot outside it whose texts are mostly repeats of other pages' goes, also
where they are many texts in turn or the host has but two pages. Inside it nothing goes for being repeated on fewer than
``LEAST_PAGES`` pages. A host may have several such elements, for several kinds of pages. Where the template says
nothing (one page, no content element), a page's own links decide.

An occurrence vector is held as the number of pages and the xor of hashed (page, count) pairs, so it is summed up like
any other statistic, over all pages of any host, before the shuffle. Copies of a page count once. What the template says
is sent to all tasks if it is little (checked), or else joined by row.

Null and empty html: empty text. Pages without a host have no template. Repeated rows
are all returned, and so are rows without an id. Other columns are ignored, whatever their names. No rows: no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from fleetmart.session import materialize

#: Least different pages of a host that a class occurs on; most rows of templates that are sent to all tasks.
LEAST_PAGES, SENT_BLOCKS = 5, 1_000_000

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small span strike strong sub sup"
    " time tt u var wbr math mi mo mn ms mtext mrow mfrac msup msub msubsup msqrt mroot munder mover munderover mtable mtr mtd mspace mstyle"
    " mpadded mphantom menclose merror semantics annotation annotation-xml mmultiscripts mprescripts none".split()
)
# Parts of a formula are told apart by a space.
FORMULA = frozenset("math mi mo mn ms mtext mrow mfrac mtr mtd mspace annotation annotation-xml".split())
CLOSED_BY_NEXT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
OUTSIDE = frozenset(
    "head nav header footer aside form menu dialog button select option datalist fieldset template svg canvas object audio video map"
    " script style textarea title noscript iframe noembed noframes".split()
)
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Class and id names that say what an element is, if all words of the name are among these or say but where or which it is.
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe subscription signup login sidebar sidebars aside rail menu menus nav navbar"
    " navigation breadcrumb breadcrumbs footer header masthead topbar comment comments reply replies respond disqus discussion share sharing"
    " social related recommended recommendations pagination pager toolbar widget widgets search form hidden".split()
)
NAME_REST = frozenset(
    "left right top bottom upper lower center main primary secondary site page global local post posts article articles story stories link links"
    " box wrapper wrap container inner outer area section block bar list item items unit slot panel content column col button buttons icons"
    " tags input field icon media".split()
)
# Names of a section in an article that can't be its own heading; its headings and paragraphs are told by no name.
SECTION_NAMES = frozenset("ad ads advert advertisement cookie cookies comment comments replies respond disqus newsletter sidebar".split())
HEADS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup".split())
MAIN = frozenset(("article", "main"))
# Where an element stands: kept; in an article that a named element holds, kept if the page has no other; in a form,
# kept if the page has no text beside it, as the form then holds the page; in a named element; outside.
KEPT, SPARE, FORM, NAMED, OUT = range(5)
# What the template says: of a block, that it belongs to a class; of a slot, that it is linked, repeated or neither; of
# an element, that it holds the content.
CLASS, LINKS, REPEATS, OWN, CONTENT = range(5)
# No menu or page header holds the article.
NO_ARTICLE = ("nav", "head", "header")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*)|=)*)(?:>|\Z)|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HOST = re.compile(r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)")


def is_outside(name: str, names: list[str], in_article: bool) -> bool:
    """Whether an element is told to be no part of the text by one of its class and id names, each taken whole."""
    if name in ("html", "body", "main", "article") or (in_article and name in HEADS):
        # An article in an article is a comment where it says so.
        return name == "article" and in_article and any(n.lower() in ("comment", "comments", "reply", "replies") for n in names)
    known = SECTION_NAMES if in_article and name == "section" else OUTSIDE_NAMES
    for whole in names:
        words = {w.lower() for w in _NAMES.findall(whole)}
        if words & known and all(w in OUTSIDE_NAMES or w in NAME_REST or w.isdigit() for w in words):
            return True
    return False


class Block:
    """A block of text, the path of the elements around it (hashed), and where it stands."""

    __slots__ = ("chars", "linked", "main", "path", "text")

    def __init__(self, text: str, path: int, main: bool, chars: int, linked: int):
        self.text, self.path, self.main, self.chars, self.linked = text, path, main, chars, linked


class Page:
    """The tokens of a page: ``tags`` counts tags by path, ``blocks`` are the texts outside what surrounds an article."""

    def __init__(self, html: str | None):
        self.tags: Counter[int] = Counter()
        self.blocks: list[Block] = []
        self.above: dict[int, int] = {}
        self._parts: list[str] = []
        self._linked = 0
        self._spare: list[Block] = []
        self._form: list[Block] = []
        # Open elements: name, path, where it stands, whether it lies in an article, its number of links.
        # Inline elements are held only if one of these changes. How many are open, by name, saves looking for none.
        self._open: list[tuple[str, int, int, bool, int]] = [("", 0, KEPT, False, 0)]
        self._count: Counter[str] = Counter()
        self._read(html or "")
        self._end_block()
        if not any(b.main for b in self.blocks):
            self.blocks += self._spare
        self.blocks = self.blocks or self._form
        #: Whether the page marks its article.
        self.marked = any(b.main for b in self.blocks)

    def _read(self, html: str) -> None:
        at, low = 0, None
        while at < len(html):
            token = _TOKEN.match(html, at)
            at = token.end()
            if token[4] is not None:
                self._text(token[4])
            elif token[2] is not None:
                name = token[2].lower()
                if token[1]:
                    self._end(name)
                    continue
                self._start(name, token[3])
                if name in RAW:
                    low = html.lower() if low is None else low
                    end = low.find(f"</{name}", at)
                    at = len(html) if end < 0 else end

    def _text(self, text: str) -> None:
        _, _, stands, _, links = self._open[-1]
        if stands < NAMED:
            self._parts.append(text)
            if links:
                self._linked += len(text.strip())

    def _start(self, name: str, attributes: str) -> None:
        inline = name in INLINE
        if name in ("br", "hr") or name in FORMULA:
            self._parts.append(" ")
        if not inline and name not in VOID:
            self._end_block()
            k = len(self._open) - 1
            while self._open[k][0] in INLINE:
                k -= 1
            if name in CLOSED_BY_NEXT.get(self._open[k][0], ()) or self._open[k][0] == "p":
                self._close(k)
            if name in MAIN and any(self._count[n] for n in NO_ARTICLE):  # it was left open
                self._close(next(k for k, e in enumerate(self._open) if e[0] in NO_ARTICLE))
        elif name == "a" and self._open[-1][0] == "a":
            self._close(len(self._open) - 1)
        if name in VOID:
            return
        above = self._open[-1]
        main = name in MAIN
        kind, stands = "", OUT if name in OUTSIDE else above[2]
        if name == "form" and above[2] < NAMED and not above[3]:
            stands = FORM
        if attributes and "=" in attributes:
            given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            main = main or given.get("role", "").strip().lower() == "main"
            kind = f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".strip()
            if kind and name not in ("html", "body") and given.get("role", "").lower() in OUTSIDE_ROLES:
                stands = OUT
            elif kind and stands < NAMED and name != "form" and not (main and name not in MAIN):
                if is_outside(name, f"{given.get('class', '')} {given.get('id', '')}".split(), above[3]):
                    stands = OUT if above[3] else NAMED
        if main and stands == NAMED and above[2] == NAMED:
            stands = SPARE if name == "article" else KEPT
        elif main and stands == FORM:
            stands = KEPT
        path = above[1] if inline else xxh64_intdigest(f"{above[1]}/{name}.{kind}")
        main = main or above[3]
        if not inline:
            self.tags[path] += 1
            self.above[path] = above[1]
        if not inline or name == "a" or stands != above[2]:
            self._open.append((name, path, stands, main, above[4] + (name == "a")))
            self._count[name] += 1

    def _end(self, name: str) -> None:
        if name not in INLINE:
            self._end_block()
        if self._count[name]:
            self._close(next(k for k in range(len(self._open) - 1, 0, -1) if self._open[k][0] == name))

    def _close(self, first: int) -> None:
        self._count.subtract(e[0] for e in self._open[first:])
        del self._open[first:]

    def _end_block(self) -> None:
        if self._parts:
            raw = "".join(self._parts)
            text = " ".join(unescape(raw).split())
            if text:
                _, path, stands, main, _ = self._open[-1]
                {SPARE: self._spare, FORM: self._form}.get(stands, self.blocks).append(Block(text, path, main, len(raw.strip()), self._linked))
            self._parts = []
        self._linked = 0

    def candidates(self) -> list[Block]:
        """Blocks of the article; without one, all."""
        return [b for b in self.blocks if b.main] if self.marked else self.blocks

    def slots(self) -> list[Block]:
        """Blocks of the article; without one, those that aren't lists of links."""
        return [b for b in self.candidates() if self.marked or 2 * b.linked <= b.chars]

    def held(self) -> Counter[int]:
        """Unlinked characters in the elements within each path."""
        own: Counter[int] = Counter()
        for b in self.blocks:
            own[b.path] += max(b.chars - b.linked, 0)
        held: Counter[int] = Counter()
        for path, above in reversed(self.above.items()):  # an element comes after those around it
            held[above] += held[path] + own[path]
        return held

    def text(self, host: str | None, said: Mapping[int, int]) -> str:
        """The page's text, given what the template of its host says by key."""
        if host is None or not said:
            return " ".join(b.text for b in self.slots())
        found = [b for b in self.candidates() if said.get(block_key(host, b)) != CLASS]
        if not self.marked:
            inside = self._inside(host, said)
            found = [b for b in found if self._stays(b, said.get(slot_key(host, b.path)), inside)]
        return " ".join(b.text for b in found)

    def _inside(self, host: str, said: Mapping[int, int]) -> set[int] | None:
        """Paths of the content element and all in it; None if the template names none on this page."""
        depth, content = {0: 0}, None
        for path, above in self.above.items():
            depth[path] = depth[above] + 1
            if said.get(tag_key(host, path)) == CONTENT and (content is None or depth[path] > depth[content]):
                content = path
        if content is None:
            return None
        inside = {content}
        for path, above in self.above.items():
            if above in inside:
                inside.add(path)
        return inside

    @staticmethod
    def _stays(block: Block, slot: int | None, inside: set[int] | None) -> bool:
        if slot == REPEATS and inside is not None and block.path not in inside:
            return False
        return slot != LINKS and (slot == OWN or 2 * block.linked <= block.chars)


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else None


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _hash(text: str) -> int:
    return _signed(xxh64_intdigest(text))


def block_key(host: str, block: Block) -> int:
    return _hash(f"{host}\0{block.path}\0{block.text}")


def slot_key(host: str, path: int) -> int:
    return _hash(f"{host}\0{path}\0")  # no block's text is empty


def tag_key(host: str, path: int) -> int:
    return _hash(f"{host}\0{path}")


def tokens(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row for each token of a page: (host, key, is_text, page, count, slot, plain, other).

    ``page`` is a hash that is the same for copies of a page. Of pages that mark no article, texts have their slot, their
    unlinked and their linked characters; tags have the unlinked characters within, and those of the whole page.
    """
    names = ["host", "key", "is_text", "page", "count", "slot", "plain", "other"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = "host long, key long, is_text boolean, page long, count int, slot long, plain long, other long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (host := host_of(url)) is None:
                    continue
                page = Page(html)
                own, site = _hash("\0".join(b.text for b in page.slots())), _hash(host)
                if page.marked:
                    rows += [(site, tag_key(host, path), False, own, n, None, None, None) for path, n in page.tags.items()]
                    rows += [(site, key, True, own, n, None, None, None) for key, n in Counter(block_key(host, b) for b in page.candidates()).items()]
                    continue
                held, whole = page.held(), sum(max(b.chars - b.linked, 0) for b in page.blocks)
                rows += [(site, tag_key(host, path), False, own, n, None, held[path], whole) for path, n in page.tags.items()]
                texts: dict[int, list[int]] = {}
                for b in page.blocks:
                    sums = texts.setdefault(block_key(host, b), [0, slot_key(host, b.path), 0, 0])
                    sums[0] += 1
                    sums[2] += max(b.chars - b.linked, 0)
                    sums[3] += b.linked
                rows += [(site, key, True, own, *sums) for key, sums in texts.items()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return pages.select(url_column, html_column).mapInArrow(run, schema)


def template(pages: DataFrame, least_pages: int = LEAST_PAGES, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(key, says): blocks of valid classes, slots of pages that mark no article, and the elements that hold their content."""
    of_page = [F.max(c).alias(c) for c in ("count", "slot", "plain", "other")]
    seen = tokens(pages, url_column, html_column).groupBy("host", "key", "is_text", "page").agg(*of_page)
    vectors = seen.groupBy("host", "key", "is_text").agg(
        F.count(F.lit(1)).alias("pages"),
        F.bit_xor(F.xxhash64("page", "count")).alias("vector"),
        F.max("count").alias("most"),
        F.max("slot").alias("slot"),
        F.sum("plain").alias("plain"),
        F.sum("other").alias("other"),
    )
    vectors = materialize(vectors.where((F.col("pages") >= least_pages) | F.col("plain").isNotNull()), "vectors")
    classes = vectors.where(F.col("pages") >= least_pages)
    valid = classes.where(~F.col("is_text")).select("host", "pages", "vector").distinct()
    blocks = classes.where("is_text").join(valid, ["host", "pages", "vector"], "left_semi").select("key", F.lit(CLASS).alias("says"))
    slots = vectors.where("slot is not null").groupBy(F.col("slot").alias("key")).agg(
        F.count(F.lit(1)).alias("texts"), F.sum("pages").alias("times"), F.sum("plain").alias("plain"), F.sum("other").alias("linked")
    )
    says = F.when(F.col("linked") > F.col("plain"), LINKS).when(2 * F.col("texts") <= F.col("times"), REPEATS).otherwise(OWN)
    slots = slots.where("times > 1").select("key", says.alias("says"))
    content = vectors.where(~F.col("is_text") & (F.col("pages") > 1) & (F.col("most") == 1) & (2 * F.col("plain") > F.col("other")))
    return blocks.union(slots).union(content.select("key", F.lit(CONTENT))).distinct()


def extract(
    pages: DataFrame, least_pages: int = LEAST_PAGES, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """(id, url, text) of every page."""
    keys = materialize(template(pages, least_pages, url_column, html_column), "template")
    schema = T.StructType([pages.schema[id_column], pages.schema[url_column], T.StructField("text", T.StringType())])
    few = keys.count() <= SENT_BLOCKS
    own = pages.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_url"), F.col(html_column).alias("_html"))
    if few:
        sent = pages.sparkSession.sparkContext.broadcast({r["key"]: r["says"] for r in keys.collect()})
        own = own.withColumn("_said", F.lit(None).cast("array<struct<key:long,says:int>>"))
    else:
        sent = pages.sparkSession.sparkContext.broadcast({})
        # By a number of the row, which no other row has: ids may be null or repeat.
        own = materialize(own.withColumn("_row", F.monotonically_increasing_id()), "pages")
        said = page_keys(own, "_row", "_url", "_html").join(keys, "key").groupBy("id").agg(F.collect_set(F.struct("key", "says")).alias("_said"))
        own = own.join(said, F.col("_row") == F.col("id"), "left").select("_id", "_url", "_html", "_said")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = sent.value
        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True)
            texts = [Page(html).text(host_of(url), everywhere if here is None else {r["key"]: r["says"] for r in here}) for url, html, here in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], schema.names)

    return own.mapInArrow(run, schema)


def page_keys(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(id, key) of all that a template may say something of, on every page with a host."""
    schema = T.StructType([T.StructField("id", pages.schema[id_column].dataType), T.StructField("key", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, keys = [], []
            for k, (url, html) in enumerate(zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True)):
                if (host := host_of(url)) is not None:
                    page = Page(html)
                    own = {block_key(host, b) for b in page.candidates()}
                    if not page.marked:
                        own.update(slot_key(host, b.path) for b in page.blocks)
                        own.update(tag_key(host, path) for path in page.above)
                    keys += own
                    where += [k] * len(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where, pa.int64())), pa.array(keys, pa.int64())], ["id", "key"])

    return pages.select(id_column, url_column, html_column).mapInArrow(run, schema)
