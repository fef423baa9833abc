"""Main text of web pages by nearest-URL page differencing.

Pages are sorted by host and URL path; each is paired with the neighbour of
its host whose path has the longer common beginning. The text lines of the
two pages are aligned by a longest common subsequence, and lines that both
have are deleted as template.

Rules about the markup stand beside the alignment, since neighbours'
menus and adverts may differ and their articles may quote each other: lines
inside elements that by element name or role are menus, headers, footers,
asides or forms, and inside containers whose class or id is a whole name of
adverts or reader comments, go whether they are shared or not (an article or
main element itself never does); containers outside articles whose whole class
or id only suggests template (menu, related, top) go if the alignment finds
half of their text or more on the other page. And if a page marks its article
(article or main), the mark is a prior: unshared lines outside go if the mark
holds at least half of what the alignment leaves, and stay otherwise (the mark
is a teaser or card). Shared lines go inside a mark too, but for headings and
prose paragraphs of an article element, which are quotes. The alignment runs
on every page; it tells nothing if the pair is two copies of one article (most
of the text is shared).

Pages' lines are dealt into ranges of the sorted order, as many as the bytes
ask for, and travel once, compressed. A task streams through its range and holds three pages
at a time; the first and last page of a range meet their neighbours from the
ranges beside it in a second pass over these two pages of each range. So every
page meets its neighbours, however many pages a host has, and nothing held in
one place grows with the input.

Defined results: a null html is empty and gives an empty text. Pages with a
null url are one host of their own. Equal paths stand in the order of their
ids, and repeated ids of a path in that of a hash of the html. Extra columns
are not read; the url comes back unchanged.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections.abc import Iterable
from itertools import groupby
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import release_memory, total_bytes, written

# Html of a range of pages, which a task streams through.
RANGE_BYTES = 64 << 20
# How hard lines are compressed before they travel.
PACK_LEVEL = 4
# Text of an output batch.
BATCH_CHARS = 4 << 20
# Share of a page's own text that a pair may share before it counts as a copy.
COPY_SHARE = 0.5

# Element names and the words of classes, ids and roles.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt
ruby s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style title textarea iframe noscript noframes template svg math xmp object select".split())
CHROME = frozenset("nav footer aside form menu dialog button fieldset head".split())
CLOSERS = frozenset("article main nav header footer aside form section body html".split())
# Whole names of adverts and reader comments, which no article is made of.
CERTAIN_NAMES = frozenset("""ad ads advert adverts advertisement advertising sponsored comments commentlist comment-list
comments-area disqus disqus_thread""".split())
# Whole names that may be template: the alignment confirms or keeps these.
SUSPECT_NAMES = frozenset("""sponsor promo promotion banner cookie cookies consent gdpr notice notices alert popup modal
overlay sidebar side rail nav navbar navigation menu breadcrumb breadcrumbs footer masthead toolbar comment discussion
respond reply replies share sharing social related recommended newsletter subscribe subscription signup login search
pagination pager widget skip header topbar top cookie-notice cookie-banner site-header site-footer main-navigation
related-posts social-share""".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
CONTAINERS = frozenset("div section ul ol dl table center details".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.S)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DROP, _ARTICLE, _OPEN, _MAIN = 0, 1, 2, 3
_MARKS = {"article": _ARTICLE, "main": _MAIN}
# Suspected elements in turn, so that neighbouring ones are told apart.
_SUSPECT = 4


def _kind_of(name: str, attributes: str, in_article: bool) -> int | None:
    """What an element makes of its lines; None: nothing."""
    if name in CHROME or name == "header" and not in_article:
        return _DROP
    if name in _MARKS:
        return _MARKS[name]
    found = None
    if attributes and "=" in attributes:
        for key, *values in _NAMED.findall(attributes):
            words = "".join(values).lower().split()
            if key.lower() == "role":
                if CHROME_ROLES.intersection(words):
                    return _DROP
                for mark in ("article", "main"):
                    if mark in words:
                        return _MARKS[mark]
            elif name in CONTAINERS:
                if CERTAIN_NAMES.intersection(words):
                    found = _DROP
                elif found is None and not in_article and SUSPECT_NAMES.intersection(words):
                    found = _SUSPECT
    return found


def text_lines(html: str) -> tuple[list[str], bytes]:
    """The page's text blocks in order, and for each whether it stands in a
    dropped element (0), in a heading or paragraph of a marked article (1), in
    none (2), elsewhere in a marked article or main part (3) or in an element
    suspected by its name (4 and 5 in turn)."""
    lines, kinds, parts = [], bytearray(), []
    regions: list[list] = []        # element, how often it is open, kind
    at, end, kind, suspects, prose = 0, len(html), _OPEN, 0, False

    def flush():
        if parts:
            line = " ".join(references.unescape("".join(parts)).split())
            parts.clear()
            if line:
                lines.append(line)
                kinds.append(_MAIN if kind == _ARTICLE and not prose else kind)

    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            parts.append(html[at:])
            break
        if token.start() > at:
            parts.append(html[at:token.start()])
        at = token.end()
        name = (token[2] or token[5] or "").lower()
        if not name:
            continue
        closing = token[1] or token[4]
        if name in INLINE and not (token[3] or token[6]):
            if name == "br":
                parts.append(" ")
            continue
        if name in UNREAD:
            if not closing and not (token[3] or token[6] or "").endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else end
            if name not in INLINE:
                flush()
            continue
        if name not in INLINE:
            flush()
            prose = not closing and name in PROSE
        elif name == "br":
            parts.append(" ")
        if closing:
            if regions and regions[-1][0] == name:
                regions[-1][1] -= 1
                if not regions[-1][1]:
                    flush()
                    regions.pop()
            elif name in CLOSERS and any(r[0] == name for r in regions):
                flush()
                while regions[-1][0] != name:
                    regions.pop()
                regions[-1][1] -= 1
                if not regions[-1][1]:
                    regions.pop()
        elif name not in VOID:
            if name in _MARKS:
                # an article that begins in an unclosed menu or header ends it
                while regions and regions[-1][2] == _DROP and regions[-1][0] in ("nav", "header", "footer", "aside"):
                    regions.pop()
            dropped = any(r[2] == _DROP for r in regions)
            # a page's main element is never a part of what is dropped around it
            new = None if dropped and name != "main" else _kind_of(
                name, token[3] or token[6], any(r[2] in _MARKS.values() for r in regions))
            if new == _SUSPECT:
                new, suspects = _SUSPECT + suspects % 2, suspects + 1
            if new is not None:
                flush()
                regions.append([name, 1, new])
            elif regions and regions[-1][0] == name:
                regions[-1][1] += 1
        kind = regions[-1][2] if regions else _OPEN
    flush()
    return lines, bytes(kinds)


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of lines, by bit
    rows: one big-integer step for each line of ``b``."""
    at: dict[str, int] = {}
    for i, line in enumerate(a):
        at[line] = at.get(line, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, rows = full, []
    for line in b:
        hit = row & at.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    i, j, found = len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.append(i)
        elif rows[j - 1] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return found[::-1]


def main_lines(lines: list[str], kinds: bytes, other: list[str] | None) -> list[str]:
    """The page's lines without markup's chrome and the template it shares
    with the paired page."""
    read = [i for i, kind in enumerate(kinds) if kind != _DROP]
    shared = set(common_lines(lines, other)).intersection(read) if other else set()
    marked = [i for i in read if kinds[i] in _MARKS.values()]
    gone = _template(lines, shared, read)
    gone |= _confirmed(lines, kinds, gone)
    if marked and _size(lines, marked) >= _size(lines, set(read) - set(marked) - gone):
        gone = _template(lines, shared, marked)
        return [lines[i] for i in marked if i not in gone or kinds[i] == _ARTICLE]
    return [lines[i] for i in read if i not in gone]


def _template(lines: list[str], shared: set[int], rows: list[int]) -> set[int]:
    """The shared lines of ``rows``; none if the pair is a copy there."""
    found = shared.intersection(rows)
    return found if _size(lines, found) <= COPY_SHARE * _size(lines, rows) else set()


def _size(lines: list[str], rows: Iterable[int]) -> int:
    return sum(len(lines[i]) for i in rows)


def _confirmed(lines: list[str], kinds: bytes, shared: set[int]) -> set[int]:
    """Lines of the suspected elements whose text is shared for the most part."""
    found: set[int] = set()
    for kind, group in groupby(range(len(kinds)), kinds.__getitem__):
        rows = list(group)
        if kind >= _SUSPECT and 2 * _size(lines, shared.intersection(rows)) >= _size(lines, rows):
            found.update(rows)
    return found


def url_key(url: str | None) -> tuple[str, str]:
    """Host and path (with its query) that pages are sorted by."""
    if url is None:
        return "", ""
    try:
        parts = urlsplit(url.strip())
        return (parts.netloc.rpartition("@")[2].lower(), parts.path + ("?" + parts.query if parts.query else ""))
    except ValueError:
        return "", url


def _common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def nearest(before: tuple | None, own: tuple, after: tuple | None) -> int:
    """-1 or 1 for the neighbour of the same host whose path has the longer
    common beginning (the earlier one of equals), 0 if there is none."""
    sides = [(_common_prefix(k[1], own[1]), side) for k, side in ((after, 1), (before, -1)) if k and k[0] == own[0]]
    return max(sides, key=lambda s: (s[0], -s[1]))[1] if sides else 0


_NO_ID = (1 << 63) - 1
_PAGE = "struct<host: string, path: string, lines: string, kinds: binary>"
_ROW = ("page_id long, url string, text string, n_chars long, part int, is_first boolean, is_last boolean, "
        f"own {_PAGE}, inner {_PAGE}")


def _key_of(url: Column) -> Column:
    """``host`` and ``path`` of a url column; only urls go through Python."""
    @F.arrow_udf("struct<host: string, path: string>")
    def keys(urls: pa.Array) -> pa.Array:
        found = [url_key(u) for u in urls.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([k[i] for k in found], pa.string()) for i in (0, 1)], ["host", "path"])

    return keys(url)


def _packed_lines(html: Column) -> Column:
    """A page's lines and their kinds, compressed: much less than its html."""
    @F.arrow_udf("binary")
    def pack(pages: pa.Array) -> pa.Array:
        out = []
        for page in pages:
            lines, kinds = text_lines(page.as_py() or "")
            out.append(zlib.compress(len(lines).to_bytes(4, "little") + bytes(kinds) + "\n".join(lines).encode(), PACK_LEVEL))
        return pa.array(out, pa.binary())

    return pack(html)


def _unpacked(data: bytes) -> tuple[str, bytes]:
    whole = zlib.decompress(data)
    count = int.from_bytes(whole[:4], "little")
    return whole[4 + count:].decode(), whole[4:4 + count]


def _lines(page: dict | None) -> list[str]:
    return page["lines"].split("\n") if page and page["lines"] else []


def _main_text(before: dict | None, own: dict, after: dict | None) -> str:
    """The page's main text, from it and its neighbours in sorted order."""
    keys = [None if p is None else (p["host"], p["path"]) for p in (before, own, after)]
    side = nearest(*keys)
    other = _lines(before if side < 0 else after) if side else None
    return "\n".join(main_lines(_lines(own), own["kinds"], other))


def extract(pages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id``,
    ``url``, ``html``)."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes(rows, "html") // range_bytes))
    key = _key_of(F.col("url"))
    order = ["key.host", "key.path", F.coalesce("page_id", F.lit(_NO_ID)), "tie"]
    dealt = rows.select("page_id", "url", key.alias("key"), F.xxhash64("html").alias("tie"), _packed_lines(F.col("html")).alias("packed"))
    dealt = dealt.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def differ(batches):
        part, before, own, ids, seen = TaskContext.get().partitionId(), None, None, None, 0
        out: list[tuple] = []

        def done(after):
            """Settle the page read last, or leave it for the ends' pass."""
            edge = (seen == 1, after is None)
            if any(edge):
                out.append((*ids, None, None, part, *edge, own, before or after))
            else:
                text = _main_text(before, own, after)
                out.append((*ids, text, len(text), None, None, None, None, None))

        def batch_of():
            names = ["page_id", "url", "text", "n_chars", "part", "is_first", "is_last", "own", "inner"]
            page = pa.struct([("host", pa.string()), ("path", pa.string()), ("lines", pa.string()), ("kinds", pa.binary())])
            types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), page, page)
            found = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)
            out.clear()
            return found

        for batch in batches:
            size = 0
            for page_id, url, packed, host, path in zip(*batch.columns, strict=True):
                lines, kinds = _unpacked(packed.as_py())
                page = {"host": host.as_py(), "path": path.as_py(), "lines": lines, "kinds": kinds}
                if own is not None:
                    done(page)
                    before = own
                own, ids, seen = page, (page_id.as_py(), url.as_py()), seen + 1
                size += len(page["lines"])
                if size > BATCH_CHARS:
                    yield batch_of()
                    size = 0
            yield batch_of()
        if own is not None:
            done(None)
            yield batch_of()
        release_memory()

    found = written(dealt.select("page_id", "url", "packed", "key.host", "key.path").mapInArrow(differ, _ROW), "pages-differenced", "zstd")
    # the first and last page of each range, with their neighbours in other ranges
    ends = found.where("part is not null")
    numbered = ends.select("part").distinct().withColumn("range", F.row_number().over(Window.orderBy("part")))
    ends = written(ends.join(numbered, "part"), "range-ends")
    last = ends.where("is_last").select((F.col("range") + 1).alias("range"), F.lit(True).alias("is_first"), F.col("own").alias("ahead"))
    first = ends.where("is_first").select((F.col("range") - 1).alias("range"), F.lit(True).alias("is_last"), F.col("own").alias("next"))
    met = ends.join(last, ["range", "is_first"], "left").join(first, ["range", "is_last"], "left").select(
        "page_id", "url", F.when(F.col("is_first"), F.col("ahead")).otherwise(F.col("inner")).alias("before"), "own",
        F.when(F.col("is_last"), F.col("next")).otherwise(F.col("inner")).alias("after"))

    def settle(batches):
        for batch in batches:
            texts = [_main_text(*(page.as_py() for page in row)) for row in zip(*batch.columns[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    spec = "page_id long, url string, text string, n_chars long"
    return found.where("part is null").select("page_id", "url", "text", "n_chars").unionByName(met.mapInArrow(settle, spec))
