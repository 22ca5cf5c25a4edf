"""HTML main text: page markup first, nearest-URL page differencing for what the markup leaves open.

Every page is read into text lines (one per block, in page order).  Markup puts
a line in one of three classes: chrome (menus, headers, footers, sidebars,
notices, adverts, forms, comments, hidden parts), article (inside an element
that the page declares as its article) or open (neither).  Pages of a host are
then ordered by URL path and each is paired with the neighbour whose path has
most leading segments in common; the lines of both are aligned by longest
common subsequence.  Shared lines are the site's, not the page's.

Every page is paired and aligned.  A page that declares an article consists of
its article lines, shared or not: texts that two pages both carry are still
their texts.  A page that does not consists of its open lines without the
shared ones; if no line would be left, the partner is a copy and the other
neighbour is asked, and a page between copies keeps its lines.

Pages are numbered in the order of (host, path, id) by a range sort, so a host
with a third of all pages is cut into as many ranges as its pages fill, and
neighbours are found by an equality join on number plus and minus one, which
has one row per key.  Only addresses, line classes and digests take part in
that; the texts stay in compressed files, a chunk of pages each, and a chunk is
read again when the alignments of its pages are known.

Edge cases: a null or empty html gives an empty text; a null or relative URL
has no host and no partner; repeated rows are pages of their own; pages with
equal hosts, paths and ids are ordered by URL and html; markup may be cut off,
unclosed or misnested; an empty table gives an empty result; other columns are
not read.  Lines are compared by a 64-bit cryptographic digest.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import exchange as X
from ridemart.llm.cluster import shared_folder
from ridemart.operators.dims import with_dense_ids

CHROME, ARTICLE, OPEN = 0, 1, 2

_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
                    "title tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style title head template noscript iframe object svg math canvas audio video map".split())
_CHROME_TAGS = frozenset("nav aside footer form fieldset legend label menu dialog button select textarea datalist".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_CHROME_WORDS = frozenset(
    "ad ads adbox adslot adunit advert adverts advertisement advertisements advertising adsense adsbygoogle sponsor sponsored promo promotion banner "
    "cookie cookies cookiebar consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login signin register paywall "
    "share sharing social related recommended recommendations trending sidebar sidebars aside widget widgets rail "
    "menu submenu nav navbar topnav navigation breadcrumb breadcrumbs topbar toolbar pagination pager skip masthead header footer copyright colophon "
    "legal disclaimer comment comments commentlist discussion disqus respond replies reply search".split())
_ARTICLE_WORDS = frozenset("article content main post entry story".split())
#: Start tags that end an open element of the same kind.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class PageReader(HTMLParser):
    """Reads a page into elements (parents before children) and text lines with the element each begins in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.words, self.marked = ["#page"], [-1], [frozenset()], [False]
        self.declared = [False]
        self.blocks: list[list[tuple[int, str]]] = []
        self._stack = [0]
        self._open: Counter = Counter()
        self._parts: list[tuple[int, str]] = []
        self._unseen = 0

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def flush(self) -> None:
        if any(not data.isspace() for _, data in self._parts):
            self.blocks.append(self._parts)
        self._parts = []

    def _pop(self) -> None:
        tag = self.tags[self._stack.pop()]
        self._open[tag] -= 1
        self._unseen -= tag in _UNSEEN
        if tag in _BLOCKS:
            self.flush()

    def _pop_to(self, wanted: set[str] | frozenset[str], bounds: frozenset[str]) -> None:
        """Close the innermost element of ``wanted``, unless one of ``bounds`` comes first."""
        if not any(self._open[t] for t in wanted):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[k]]
            if tag in wanted:
                while len(self._stack) > k:
                    self._pop()
                return
            if tag in bounds:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCKS:
            self._pop_to({"p"}, _P_BOUNDS)
            if tag in _ENDS:
                self._pop_to(_ENDS[tag], _LIST_BOUNDS)
            self.flush()
        elif tag == "br":
            self._parts.append((self._stack[-1], " "))
        if self._open["head"] and (tag == "body" or tag in _BLOCKS and tag not in ("head", "title")):
            while self._open["head"]:
                self._pop()
        if tag in _VOID:
            return
        a = {k: v or "" for k, v in attrs}
        words = frozenset(_WORDS.findall(_CAMEL.sub(" ", f"{a.get('class', '')} {a.get('id', '')}").lower())) if "class" in a or "id" in a else frozenset()
        role = a.get("role", "").lower()
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.words.append(words)
        self.marked.append(tag in _CHROME_TAGS or role in _CHROME_ROLES or "hidden" in a or a.get("aria-hidden") == "true"
                           or ("style" in a and _HIDDEN.search(a["style"].lower()) is not None))
        self.declared.append(tag in ("article", "main") or role in ("article", "main") or a.get("itemprop") == "articleBody")
        self._stack.append(len(self.tags) - 1)
        self._open[tag] += 1
        self._unseen += tag in _UNSEEN

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "math") or self._open["svg"] or self._open["math"]:  # a slash closes no element of HTML itself
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
            self._pop_to({tag}, frozenset())
        else:
            self._pop_to({tag}, _BLOCKS)

    def handle_data(self, data: str) -> None:
        if self._unseen == 0:
            self._parts.append((self._stack[-1], data))

    # --- lines and their classes --------------------------------------------

    def _chrome(self, exempt: set[int], in_article: set[int]) -> list[bool]:
        """Per element: it or an ancestor is chrome; exempt elements (the article and what holds it) are not."""
        out = [False]
        for e in range(1, len(self.tags)):
            own = self.marked[e] or bool(self.words[e] & _CHROME_WORDS and self.tags[e] not in ("html", "body"))
            if e not in in_article:
                own = own or self.tags[e] == "header"
            elif self.tags[e] == "header" or "header" in self.words[e]:
                own = self.marked[e] or bool((self.words[e] - {"header"}) & _CHROME_WORDS)
            out.append(out[self.parents[e]] or (own and e not in exempt))
        return out

    def _innermost(self, named: list[int], chars: list[int]) -> list[int]:
        """The named element with most text, or the one inside it that has most of that, and so on inwards."""
        if not named:
            return []
        root = max(named, key=lambda e: (chars[e], -e))
        for e in named:  # parents come before children
            up = self.parents[e]
            while up > root:
                up = self.parents[up]
            if up == root and 2 * chars[e] > chars[root]:
                root = e
        return [root]

    def _article(self) -> tuple[list[bool], list[bool]]:
        """Per element: inside an article; chrome."""
        n = len(self.tags)
        chars = [0] * n
        for block in self.blocks:
            for e, data in block:
                chars[e] += len(data.strip())
        for e in range(n - 1, 0, -1):
            chars[self.parents[e]] += chars[e]
        plain = self._chrome(set(), set())

        def among(test) -> list[int]:
            found = [e for e in range(1, n) if test(e) and chars[e]]
            return [e for e in found if not plain[e]] or [e for e in found if not self.marked[e] and not self.words[e] & _CHROME_WORDS]

        candidates = among(lambda e: self.tags[e] == "article" or (self.declared[e] and self.tags[e] != "main")) or among(lambda e: self.declared[e])
        if not candidates:
            named = among(lambda e: self.tags[e] in ("div", "section", "td") and self.words[e] & _ARTICLE_WORDS and not self.words[e] & _CHROME_WORDS)
            candidates = self._innermost(named, chars)
        inside = [False] * n
        if not candidates:
            return inside, plain
        exempt, up = set(), max(candidates, key=lambda e: (chars[e], -e))
        while up > 0:
            exempt.add(up)
            up = self.parents[up]
        taken = set(candidates)
        for e in range(1, n):
            inside[e] = inside[self.parents[e]] or e in taken
        return inside, self._chrome(exempt, {e for e in range(1, n) if inside[e]})

    def lines(self) -> tuple[list[str], list[int]]:
        """Text and class of every line; chrome inside a line of another class is left out of it."""
        self.flush()
        inside, chrome = self._article()
        texts, classes = [], []
        for block in self.blocks:
            own = [(e, data) for e, data in block if not chrome[e]]
            first = next((e for e, data in own if not data.isspace()), None)
            texts.append(" ".join("".join(data for _, data in (block if first is None else own)).split()))
            classes.append(CHROME if first is None else ARTICLE if inside[first] else OPEN)
        return texts, classes


_P_BOUNDS = frozenset("article section div table td th li blockquote body button form main aside figure".split())
_LIST_BOUNDS = frozenset("ul ol dl table select menu body article section".split())


def read_page(html: str | None) -> tuple[list[str], list[int]]:
    """Text lines of a page and their classes."""
    reader = PageReader()
    reader.feed(html or "")
    reader.close()
    return reader.lines()


# --- alignment -------------------------------------------------------------

def _rows(a: list, b: list) -> Iterator[int]:
    """Bit rows of the LCS table of ``a`` against ``b``: a zero bit j means that row's length grows at b[j]."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _last_lengths(a: list, b: list) -> np.ndarray:
    """LCS length of all of ``a`` with every prefix of ``b``."""
    v = (1 << len(b)) - 1
    for v in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes((len(b) + 7) // 8 or 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _aligned(a: list, b: list, cells: int) -> list[int]:
    """Places in ``a`` of one longest common subsequence with ``b``."""
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > cells:  # halve a, cut b where the lengths of both halves add up to most
        half = len(a) // 2
        cut = int((_last_lengths(a[:half], b) + _last_lengths(a[half:][::-1], b[::-1])[::-1]).argmax())
        return _aligned(a[:half], b[:cut], cells) + [half + k for k in _aligned(a[half:], b[cut:], cells)]
    rows = list(_rows(a, b))
    i, j, out = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return out[::-1]


def shared_lines(a: list, b: list, cells: int = 1 << 28) -> list[bool]:
    """Which lines of ``a`` are on a longest common subsequence with ``b``; memory is at most ``cells`` bits."""
    n = min(len(a), len(b))
    head = next((k for k in range(n) if a[k] != b[k]), n)
    tail = next((k for k in range(n - head) if a[-1 - k] != b[-1 - k]), n - head)
    out = [True] * head + [False] * (len(a) - head - tail) + [True] * tail
    mine, theirs = set(a[head:len(a) - tail]), set(b[head:len(b) - tail])
    left = [k for k in range(head, len(a) - tail) if a[k] in theirs]
    other = [x for x in b[head:len(b) - tail] if x in mine]
    for k in _aligned([a[k] for k in left], other, cells):
        out[left[k]] = True
    return out


def common_segments(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


@dataclass(frozen=True)
class Neighbour:
    page_id: int | None
    path: str
    keys: list[int]


def own_lines(classes: list[int]) -> list[int]:
    """Places of the lines that a page's text can have: its article lines, or without any its open ones."""
    wanted = ARTICLE if ARTICLE in classes else OPEN
    return [k for k, c in enumerate(classes) if c == wanted]


def aligned_lines(classes: list[int], keys: list[int], path: str, neighbours: list[Neighbour]) -> tuple[list[int] | None, int | None, int, int]:
    """(places kept of the own lines, None for all; partner's id, shared lines, deleted lines) of one page next to its neighbours of the same host."""
    partner, n_shared = None, 0
    for near in sorted(neighbours, key=lambda x: -common_segments(path, x.path)):
        shared = shared_lines(keys, near.keys)
        if partner is None:
            partner, n_shared = near.page_id, sum(shared)
        if ARTICLE in classes:
            break
        own = own_lines(classes)
        rest = [j for j, k in enumerate(own) if not shared[k]]
        if rest:
            return rest, near.page_id, sum(shared), len(own) - len(rest)
    return None, partner, n_shared, 0


def main_lines(lines: list[str], classes: list[int], keys: list[int], path: str, neighbours: list[Neighbour]) -> tuple[list[str], int | None, int, int]:
    """(kept lines, partner's id, shared lines, deleted lines) of one page next to its neighbours of the same host."""
    kept, *found = aligned_lines(classes, keys, path, neighbours)
    own = [lines[k] for k in own_lines(classes)]
    return (own if kept is None else [own[j] for j in kept], *found)


# --- Spark -----------------------------------------------------------------

#: What takes part in the pairing of pages: the place of their lines (file, row), the address, line classes and digests.
PAGE_SCHEMA = "chunk string, at int, page_id long, url string, host string, path string, classes array<int>, keys array<long>"
ALIGNED_SCHEMA = "chunk string, at int, kept array<int>, paired_page_id long, n_shared_lines long, n_deleted_lines long"
MAIN_SCHEMA = "page_id long, url string, text string, paired_page_id long, n_lines long, n_shared_lines long, n_deleted_lines long"


def _key(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def read_pages(pages: DataFrame, folder: str, chunk_bytes: int = 4 << 20) -> DataFrame:
    """Every page's address, line classes and line digests; its own lines go to the file of its chunk."""
    url = F.coalesce("url", F.lit(""))
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)"
    taken = pages.select("page_id", "url", F.nullif(F.lower(F.regexp_extract(url, parts, 1)), F.lit("")).alias("host"),
                         F.regexp_extract(url, parts, 2).alias("path"), F.col("html").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in X.text_chunks(batches, chunk_bytes):
            own, sizes, classes, keys = [], [], [], []
            for html in whole.column("text"):
                lines, found = read_page(html.as_py())
                own.append([lines[k] for k in own_lines(found)])
                sizes.append(len(lines))
                classes.append(found)
                keys.append([_key(t) for t in lines])
            texts = whole.select(["page_id", "url"]).append_column("own", pa.array(own, pa.list_(pa.string()))).append_column("n_lines", pa.array(sizes, pa.int64()))
            chunk = X.save_texts(folder, texts).rsplit("/", 1)[1]
            n = whole.num_rows
            columns = [pa.array([chunk] * n), pa.array(range(n), pa.int32()), *(whole.column(c).combine_chunks() for c in ("page_id", "url", "host", "path")),
                       pa.array(classes, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "at", "page_id", "url", "host", "path", "classes", "keys"])

    return taken.mapInArrow(read, PAGE_SCHEMA)


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for chunk, at, path, classes, keys, *sides in zip(*[c.to_pylist() for c in b.columns]):
            near = [Neighbour(s["page_id"], s["path"], s["keys"]) for s in sides if s is not None]
            out.append((chunk, at, *aligned_lines(classes, keys, path, near)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ALIGNED_TYPES)], _ALIGNED_NAMES)


def _texts(folder: str):
    """The result rows of a chunk from its file and its pages' alignments."""
    def one(aligned: pa.Table) -> pa.Table:
        aligned = aligned.sort_by("at")
        pages = X.load_texts(f"{folder}/{aligned.column('chunk')[0].as_py()}")
        texts = ["\n".join(own if kept is None else [own[j] for j in kept]) for own, kept in zip(pages.column("own").to_pylist(), aligned.column("kept").to_pylist())]
        return pa.table({"page_id": pages.column("page_id"), "url": pages.column("url"), "text": pa.array(texts, pa.string()), "paired_page_id": aligned.column("paired_page_id"),
                         "n_lines": pages.column("n_lines"), "n_shared_lines": aligned.column("n_shared_lines"), "n_deleted_lines": aligned.column("n_deleted_lines")})
    return one


def extract_main_text(pages: DataFrame) -> DataFrame:
    """The main text of every page, with its partner and the lines that both share."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "main-text")
    read_pages(pages, f"{folder}/lines").write.option("compression", "zstd").parquet(f"{folder}/pages")
    read = spark.read.schema(PAGE_SCHEMA).parquet(f"{folder}/pages")
    chunks = read.where("at = 0").count()
    # Only addresses, classes and line digests are sorted and meet their neighbours.
    placed = with_dense_ids(read.where("host is not null"), ["host", "path", "page_id", "url", "keys"], "place")
    slim = placed.select("place", "host", F.struct("page_id", "path", "keys").alias("page"))

    def beside(step: int, name: str) -> DataFrame:
        return slim.select((F.col("place") + step).alias("place"), F.col("host").alias(f"{name}_host"), F.col("page").alias(name))

    def same_host(name: str):
        return F.when(F.col(f"{name}_host") == F.col("host"), F.col(name)).alias(name)

    wanted = ["chunk", "at", "path", "classes", "keys"]
    near = (placed.select("place", "host", *wanted).join(beside(1, "before"), "place", "left").join(beside(-1, "after"), "place", "left")
            .select(*wanted, same_host("before"), same_host("after")))
    alone = read.where("host is null").select(*wanted)
    aligned = near.unionByName(alone, allowMissingColumns=True).mapInArrow(_align, ALIGNED_SCHEMA)
    return aligned.repartition(max(1, chunks), "chunk").groupBy("chunk").applyInArrow(_texts(f"{folder}/lines"), MAIN_SCHEMA)


_ALIGNED_NAMES = ["chunk", "at", "kept", "paired_page_id", "n_shared_lines", "n_deleted_lines"]
_ALIGNED_TYPES = [pa.string(), pa.int32(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.int64()]


def main_text_report(extracted: DataFrame) -> DataFrame:
    """The extracted pages with the length of their text in code points."""
    return extracted.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "paired_page_id", "n_lines", "n_shared_lines", "n_deleted_lines")
