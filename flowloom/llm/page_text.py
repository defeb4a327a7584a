"""Main text of web pages: differencing against nearby pages, then a check by structure.

A page is cut into lines (blocks of text). Every page is paired with the pages of the nearest urls, its lines are
aligned with theirs by longest common subsequence, those of an article too, and lines that they share are struck out.
Structure then checks what is left and what is struck out, and restores an article's lines. Each block lies in one of three zones: `chrome`
(menus, headers, footers, sidebars, notices, adverts, forms, comments by tag or by a
whole class, id or role) goes also if no other page shares it; `content` (inside article or main) stays also if another
article has the same sentence; but an article in a form or in a container that only its name makes chrome is content. In
the `open` zone (neither), differencing decides, unless the page has content, which is then its article.

The nearest urls are those before and after a page's in the order of (host, path), by
directories, among pages of other lines; so they share the deepest directory that has
such pages, up to the host's root. Pages are ordered by a range split, and runs of equal
lines are numbered across its parts, so a host with most of the pages is no
single task. Only hashes of lines are ordered and aligned. Differencing alone can't give the article (see the README): it
would delete sentences that two articles share and keep menus that differ.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator, Sequence
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowloom.llm.url_filter import host_of, path_of
from flowloom.session import settle

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:script|style|noscript|template|iframe|svg|math|object|select|textarea|button|title)(?:\s(?:\"[^\"]*\"|'[^']*'|[^'\">])*(?<=[\s\"']))?/>"
    r"|<(script|style|noscript|template|iframe|svg|math|object|select|textarea|button|title)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>", re.S | re.I)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: Elements whose text flows on in the block around them; any other tag ends a block.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that only hold other things than an article's text.
CHROME_TAGS = frozenset("nav footer aside form dialog menu head".split())
#: Words of class, id or role that mark them.
CHROME_WORDS = frozenset((
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination popup promo related "
    "search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget").split())
#: Words that may stand beside them in a name, as in site-header; other words make it a name of its own.
LAYOUT_WORDS = frozenset((
    "site page main top bottom left right primary secondary global wrap wrapper container inner outer box bar block area list item items "
    "link links form button buttons post posts entry article articles").split())
#: Elements that no word of their own makes chrome.
TEXT_TAGS = frozenset("article main h1 h2 h3 h4 h5 h6".split())
CONTENT_TAGS = frozenset(("article", "main"))
CHROME, OPEN, CONTENT = 0, 1, 2
REOPENS = -1  # chrome in which an article is content again


def is_chrome(names: str) -> bool:
    """Whether one of the names (a class, id or role) has a chrome word and otherwise layout words only."""
    for name in names.lower().split():
        parts = {w for w in _WORD.findall(name) if len(w) > 1}
        if not CHROME_WORDS.isdisjoint(parts) and parts <= CHROME_WORDS | LAYOUT_WORDS:
            return True
    return False


def blocks(page: str) -> list[tuple[int, str]]:
    """(zone, text) of every non-empty block, in page order."""
    out: list[tuple[int, str]] = []
    open_tags: list[tuple[str, int]] = []  # containers, with the zone inside them
    text: list[str] = []
    at = 0

    def close_block() -> None:
        if text:
            line = _SPACE.sub(" ", html_lib.unescape("".join(text))).strip()
            text.clear()
            if line:
                out.append((max(open_tags[-1][1], CHROME) if open_tags else OPEN, line))

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if m[3] is None:  # a comment, a declaration or an element without text
            continue
        tag = m[3].lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        close_block()
        if m[2]:
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == tag:
                    del open_tags[k:]
                    break
        elif tag not in VOID and tag not in ("p", "html", "body") and not m[4].endswith("/"):
            zone = open_tags[-1][1] if open_tags else OPEN
            if zone != CHROME:
                named = "=" in m[4] and is_chrome(" ".join("".join(n) for n in _NAMES.findall(m[4])))
                if tag in CHROME_TAGS or (tag == "header" and zone != CONTENT):
                    zone = REOPENS if tag == "form" and zone != CONTENT else CHROME
                elif tag in CONTENT_TAGS:
                    zone = CHROME if named and zone == REOPENS and tag == "article" else CONTENT  # a comment among comments
                elif named and tag not in TEXT_TAGS:
                    zone = CHROME if zone == CONTENT else REOPENS
            open_tags.append((tag, zone))
    text.append(page[at:])
    close_block()
    return out


def shared_lines(lines: Sequence[int], other: Sequence[int], most_matches: int = 1 << 18) -> set[int]:
    """Places in `lines` of one longest common subsequence of both (Hunt and Szymanski's method).

    Its work grows with the equal pairs; where lines are repeated so often that these are more than `most_matches`,
    rows of bits give the subsequence.
    """
    here, there = Counter(lines), Counter(other)
    if sum(n * there[x] for x, n in here.items()) > most_matches:
        at = [i for i, x in enumerate(lines) if x in there]
        return {at[i] for i in _shared_by_bits([lines[i] for i in at], [x for x in other if x in here])}
    where: dict[int, list[int]] = {}
    for j, x in enumerate(other):
        where.setdefault(x, []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, x in enumerate(lines):
        for j in reversed(where.get(x, ())):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    found, link = set(), links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def _bits(places: Sequence[int]) -> int:
    out = bytearray(places[-1] // 8 + 1)
    for j in places:
        out[j >> 3] |= 1 << (j & 7)
    return int.from_bytes(out, "little")


def _bit_rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """For each start of `a`, a number whose j lowest bits have a zero for each line that it shares with the first j of `b`."""
    where: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    often = {x: _bits(p) for x, p in where.items() if len(p) >= 64}
    full = row = (1 << len(b)) - 1
    for x in a:
        if x in where:
            equal = row & (often.get(x) or _bits(where[x]))
            row = ((row + equal) | (row - equal)) & full
        yield row


def _shared_by_bits(a: Sequence[int], b: Sequence[int], first: int = 0, most_bits: int = 1 << 28) -> set[int]:
    """`first` plus the places in `a` of one longest common subsequence; halves are solved apart where the rows would be too much (Hirschberg's method)."""
    n, m = len(a), len(b)
    if not n or not m:
        return set()
    if n == 1 or n * m <= most_bits:
        rows, found, i, j = list(_bit_rows(a, b)), set(), n, m
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                found.add(first + i)
                j -= 1
        return found

    def shared(x: Sequence[int], y: Sequence[int]) -> np.ndarray:
        row = deque(_bit_rows(x, y), 1)[0].to_bytes(m // 8 + 1, "little")
        return np.append(0, np.cumsum(1 - np.unpackbits(np.frombuffer(row, np.uint8), bitorder="little")[:m].astype(np.int64)))

    half = n // 2
    cut = int(np.argmax(shared(a[:half], b) + shared(a[half:][::-1], b[::-1])[::-1]))
    return _shared_by_bits(a[:half], b[:cut], first, most_bits) | _shared_by_bits(a[half:], b[cut:], first + half, most_bits)


def _key(line: str, kind: bytes = b"") -> int:
    return int.from_bytes(blake2b(line.encode(), digest_size=8, person=kind).digest(), "big", signed=True)


def _keys(found: list[tuple[int, str]]) -> np.ndarray:
    """A hash for each line, in an article or not: other pages' menus that quote an article's line don't share it."""
    return np.array([_key(line, b"article" if zone == CONTENT else b"") for zone, line in found], np.int64)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of each page's lines."""
    for batch in batches:
        keys = [_keys(blocks(page.as_py() or "")) for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("path"), pa.array(keys, pa.list_(pa.int64()))], ["host", "path", "keys"])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The article's text, or the open lines and their places; the places of an article's lines and of the others; the hashes."""
    for batch in batches:
        content, lines, at, inside, outside, keys = [], [], [], [], [], []
        for page in batch.column("html"):
            found = blocks(page.as_py() or "")
            zones = np.array([z for z, _ in found], np.int32)
            kept, rest = np.flatnonzero(zones == CONTENT).astype(np.int32), np.flatnonzero(zones != CONTENT).astype(np.int32)
            open_ = rest[:0] if len(kept) else np.flatnonzero(zones == OPEN).astype(np.int32)
            content.append("\n".join(found[i][1] for i in kept))
            lines.append([found[i][1] for i in open_])
            at.append(open_)
            inside.append(kept)
            outside.append(rest)
            keys.append(_keys(found))
        places = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(content, pa.string()), pa.array(lines, pa.list_(pa.string())),
             *(pa.array(x, places) for x in (at, inside, outside)), pa.array(keys, pa.list_(pa.int64()))],
            ["id", "url", "content", "lines", "at", "inside", "outside", "keys"])


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the lines that a page shares with a reference."""
    for batch in batches:
        out = []
        for keys, near in zip(batch.column("keys"), batch.column("near")):
            keys, gone = keys.as_py(), set()
            for other in near.as_py() or ():
                if other and other != keys:
                    gone |= shared_lines(keys, other)
            out.append(np.array(sorted(gone), np.int32))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("host", "path", "h")), pa.array(out, pa.list_(pa.int32()))], ["host", "path", "page", "shared"])


def nearest_references(parsed: DataFrame) -> DataFrame:
    """(host, path, h, keys, near): lines of the pages of other lines before and after each page by url; h is the hash of its own."""
    by_url = ["host", "place", "h"]
    ordered = (parsed.filter(F.size("keys") > 0).groupBy("host", "path", "h").agg(F.first("keys").alias("keys"))
               .withColumn("place", F.translate("path", "/", "\u0001"))  # a directory's pages stand together
               .repartitionByRange(*by_url).withColumn("part", F.spark_partition_id()))
    ordered = settle(ordered, "page-order")
    within = W.partitionBy("part").orderBy(*by_url)
    before = F.lag(F.struct("host", "h")).over(within)
    parts = W.orderBy("part")  # a row a part
    last = ordered.groupBy("part").agg(F.max(F.struct(*by_url)).alias("last")).withColumn("last", F.lag("last").over(parts))
    changes = (ordered.withColumn("before", before).join(last, "part")
               .withColumn("before", F.coalesce("before", F.struct("last.host", "last.h")))
               .withColumn("new", (~F.col("before").eqNullSafe(F.struct("host", "h"))).cast("long")))
    changes = settle(changes.withColumn("run", F.sum("new").over(within.rowsBetween(W.unboundedPreceding, 0)))
                     .select("host", "path", "h", "keys", "part", "run", "new"), "page-runs")
    start = (changes.groupBy("part").agg(F.sum("new").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(parts.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first")))
    numbered = changes.join(start, "part").withColumn("run", F.col("run") + F.col("first"))
    runs = numbered.filter(F.col("new") == 1).select("host", "run", "keys")
    for name, step in (("left", 1), ("right", -1)):
        other = runs.select("host", (F.col("run") + step).alias("run"), F.col("keys").alias(name))
        numbered = numbered.join(other, ["host", "run"], "left")
    return numbered.select("host", "path", "h", "keys", F.array("left", "right").alias("near"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of `pages`: id, url, text, n_chars (code points), n_shared (lines outside an article that were
    struck out because a reference shares them), n_restored (lines of an article that were struck out and that structure restored).

    A null or empty page has the empty text. Character references are decoded, white space
    inside a block becomes one blank, blocks are joined by one newline. Every page is differenced with all its lines; one
    without article or main and with no other page near keeps its
    open blocks. A null url counts as the empty host. Repeated rows stay; other
    columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    id_type = rows.schema["id"].dataType.simpleString()
    h = F.xxhash64("keys").alias("h")
    # pages are parsed twice, as their texts would take more disk than that when written aside
    lined = rows.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html").mapInArrow(_keyed, "host string, path string, keys array<long>")
    near = nearest_references(lined.select("host", "path", "keys", h))
    shared = settle(near.mapInArrow(_differenced, "host string, path string, page long, shared array<int>"), "page-shared")
    parsed = rows.mapInArrow(_parsed, f"id {id_type}, url string, content string, lines array<string>, at array<int>, inside array<int>, outside array<int>, keys array<long>")
    parsed = parsed.select("id", "url", "content", "lines", "at", "inside", "outside", h)
    own = (host_of(F.col("url")) == F.col("host")) & (path_of(F.col("url")) == F.col("path")) & (F.col("h") == F.col("page"))
    parsed = parsed.join(shared.hint("merge"), own, "left").withColumn("shared", F.coalesce("shared", F.array().cast("array<int>")))
    kept = F.filter("lines", lambda line, i: ~F.array_contains("shared", F.get("at", i)))
    text = F.when(F.size("lines") > 0, F.array_join(kept, "\n")).otherwise(F.col("content"))
    struck, restored = (F.size(F.array_intersect(x, "shared")).cast("long") for x in ("outside", "inside"))
    full = parsed.select("id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"), struck.alias("n_shared"), restored.alias("n_restored"))
    return full.withColumnsRenamed({"id": id_col, "url": url_col})
