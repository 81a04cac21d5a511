"""Main text of web pages: nearest-URL page differencing with structure marks.

Every page is parsed into lines (one per block). Lines inside navigation, headers, footers, asides,
forms, adverts, notices, comments and the like are left out by their tags, roles and class names. A class name
counts as a whole: of its parts one must name such an element and the others nothing but its place or
kind, so ``post comments-open``, ``no-sidebar`` or ``related-work`` leave nothing out. Where the page marks its
article (``article``, ``main``, ``itemprop=articleBody``, content classes), the lines below the innermost kind of mark that
holds half of what the next outer kind holds are the text, so a quoted ``article`` inside ``main`` is a part of it.
Every page, marked or not, is compared with a sibling: pages are ordered by host and URL path,
pages of a host with equal lines count as one,
each is paired with the adjacent page of its host whose path agrees longest, the lines of both are aligned
by longest common subsequence, and the shared lines, the site's frame, are deleted. Of the lines that a
page marks as its article, a kind of mark further in (boxes inside the article) goes if the sibling repeats it whole and most of
the article around it is not shared. Others stay even if the sibling repeats them: article text may be a copy.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warband.session import materialize

# Element names, roles and name parts that mark what is not article text.
DROP_TAGS = frozenset("nav footer aside form script style noscript template iframe object svg canvas button select "
                      "option dialog menu head title textarea input label fieldset audio video math".split())
RAW_TAGS = frozenset("script style noscript template iframe textarea title svg math".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
DROP_NAMES = frozenset("ad ads adv advert adverts advertisement advertisements advertising adslot banner sponsor sponsored promo "
                       "promos promotion cookie cookies consent gdpr notice notices alert popup modal overlay sidebar sidenav "
                       "comment comments commentlist disqus respond replies menu navbar nav navigation breadcrumb breadcrumbs "
                       "footer masthead topbar toolbar share sharing social related recommended recommendations newsletter "
                       "subscribe subscription signup login search widget widgets pagination pager skiplink copyright "
                       "disclaimer tagcloud".split())
HEADER_NAMES = frozenset(["header"])
#: What the other parts of a compound name may be: places, kinds and sizes of page parts.
PLAIN_NAMES = frozenset("area article aside bar block body bottom box btn button buttons card cards center col column container content "
                        "entry fixed form global group grid header hero horizontal icons inner item items left leaderboard link links list "
                        "local main mobile module outer page panel post primary rail rectangle region right row secondary section site "
                        "slot sticky sub text thread title top unit vertical wrap wrapper zone".split())
#: Frame elements that hold no article: one that starts inside shows that the element was not closed, or wraps the page.
UNCLOSED = frozenset("nav header form".split())
MAIN_NAMES = frozenset("article articlebody post entry story content main maincontent".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                       "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                       "section summary table tbody tfoot thead tr ul".split())
SPACED_TAGS = frozenset(["br", "td", "th", "img"])
# Opening the key closes an open element of the listed names first.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}

_MARKUP = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])")
_TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*[\"']")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
OTHER, CONTENT, MAIN, ARTICLE = 0, 1, 2, 3


@lru_cache(maxsize=20_000)
def judge(tag: str, raw: str) -> tuple[bool, bool, int]:
    """(dropped, dropped outside an article, level of article mark) of an element."""
    attrs = {}
    if raw:
        for m in _ATTR.finditer(raw):
            attrs.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    names = [(n.lower(), {p.lower() for p in _NAME_PART.findall(n) if not p.isdigit()})
             for n in (attrs.get("class", "") + " " + attrs.get("id", "")).split()]
    named = lambda kind: any(n in kind or p & kind and not p - kind - DROP_NAMES - PLAIN_NAMES for n, p in names)
    role = attrs.get("role", "").lower()
    frame = tag in ("html", "body", "main")
    drop = tag in DROP_TAGS or role in DROP_ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" \
        or re.search(r"display\s*:\s*none", attrs.get("style", "")) is not None or named(DROP_NAMES)
    outside = tag == "header" or named(HEADER_NAMES)
    if tag == "article" or role == "article" or attrs.get("itemprop", "").lower() == "articlebody":
        level = ARTICLE
    elif tag == "main" or role == "main":
        level = MAIN
    elif tag in ("div", "section") and any(n in MAIN_NAMES or p & MAIN_NAMES for n, p in names):
        level = CONTENT
    else:
        level = OTHER
    return drop and not frame, outside and not frame, level


def markup(source: str):
    """(start, end, name, ends an element, attributes) of every tag, (start, end, None, False, text) of comments, CDATA
    sections and declarations; sent a position, it goes on there. One pass: quotes count only after an equals sign, and
    one that is never closed opens no value. Nothing that is left open at the end is a tag."""
    at, unclosed = 0, set()
    while m := _MARKUP.search(source, at):
        start, kind = m.start(), m[0]
        if kind in ("<!--", "<![CDATA["):
            end = source.find("-->" if kind == "<!--" else "]]>", m.end())
            text = source[m.end():end if end >= 0 else len(source)] if kind == "<![CDATA[" else ""
            at = end + 3 if end >= 0 else len(source)
            yield start, at, None, False, text
            continue
        if kind in ("<!", "<?"):
            end = source.find(">", m.end())
            if end < 0:
                return
            at = end + 1
            yield start, at, None, False, ""
            continue
        name = _TAG_NAME.match(source, start)
        at = name.end()
        while True:
            stop = _STOP.search(source, at)
            if stop is None:
                return
            if stop[0] == ">":
                break
            at, quote = stop.end(), stop[0][-1]
            if quote not in unclosed:
                end = source.find(quote, at)
                if end < 0:
                    unclosed.add(quote)
                else:
                    at = end + 1
        at = stop.end()
        jump = yield start, at, name[1].lower(), source[start + 1] == "/", source[name.end():stop.start()]
        if jump is not None:
            at = jump
            yield


def page_lines(source: str) -> list[tuple[str, int]]:
    """Lines of a page with their article level, without the elements that are never article text."""
    lines: list[tuple[str, int]] = []
    words: list[str] = []
    stack: list[tuple[str, str | None, int]] = []  # (tag, tag of the dropped element here or above, level here or above)
    where: dict[str, list[int]] = {}               # places of each tag in the stack
    blocks: list[int] = []                         # places of block elements and cells
    dropped: str | None = None
    level = OTHER

    def flush() -> None:
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            words.clear()
            if text:
                lines.append((text, level))

    def cut(size: int) -> None:
        nonlocal dropped, level
        while len(stack) > size:
            where[stack.pop()[0]].pop()
        while blocks and blocks[-1] >= size:
            blocks.pop()
        _, dropped, level = stack[-1] if stack else ("", None, OTHER)

    def innermost(tags) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=-1)

    at, lower = 0, None
    tags = markup(source)
    for start, end, tag, closes, attrs in tags:
        if start > at and dropped is None:
            words.append(source[at:start])
        at = end
        if tag is None:
            if attrs and dropped is None:
                words.append(html.escape(attrs))
            continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
        elif tag in SPACED_TAGS and dropped is None:
            words.append(" ")
        if closes:
            k = innermost([tag])
            if k >= 0 and (block or not blocks or blocks[-1] <= k):       # an inline end tag closes no block
                if stack[k][1] != dropped or stack[k][2] != level:
                    flush()
                cut(k)
            continue
        if tag in VOID_TAGS or attrs.endswith("/") and not block:
            continue
        closing = CLOSES.get(tag, ("p",) if block else ())
        while closing and (k := innermost(closing)) >= 0 and (not blocks or blocks[-1] <= k):
            cut(k)
        # long attributes are seldom met again and would fill the table of judgements
        drop, outside, mark = (judge if len(attrs) < 1_000 else judge.__wrapped__)(tag, attrs.strip().rstrip("/"))
        mine = drop or outside and level == OTHER
        if dropped in UNCLOSED and mark >= MAIN and not mine:
            dropped = None
        if mine and dropped is None or mark > level:
            flush()
        dropped, level = dropped or (tag if mine else None), max(level, mark)
        if block or tag in ("td", "th"):
            blocks.append(len(stack))
        where.setdefault(tag, []).append(len(stack))
        stack.append((tag, dropped, level))
        if tag in RAW_TAGS:
            lower = source.lower() if lower is None else lower
            stop = lower.find(f"</{tag}", at) if len(lower) == len(source) else -1
            if stop < 0:
                found = re.compile(f"</{tag}", re.I).search(source, at)
                stop = found.start() if found else len(source)
            at = stop
            tags.send(at)
    if at < len(source) and dropped is None:
        words.append(source[at:])
    flush()
    return lines


def article_level(sizes: list[int], levels: list[int]) -> int:
    """The innermost kind of mark that holds half of the text of the next outer kind, OTHER without marks."""
    size = lambda least: sum(n for n, v in zip(sizes, levels) if v >= least)
    best = max(levels, default=OTHER)
    for outer in sorted({v for v in levels if OTHER < v < best}, reverse=True):
        if 2 * size(best) < size(outer):
            best = outer
    return best


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Indices into ``a`` of a longest common subsequence with ``b`` (Hunt and Szymanski)."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    out = set(range(lo)) | set(range(len(a) - hi, len(a)))
    places: dict[int, list[int]] = {}
    for j in range(len(b) - hi - 1, lo - 1, -1):
        places.setdefault(b[j], []).append(j)
    tails, links = [], []                          # smallest end in b of a chain of each length; its last link
    for i in range(lo, len(a) - hi):
        for j in places.get(a[i], ()):
            k = bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def kept_lines(sizes: list[int], levels: list[int], hashes: list[int], sibling: list[int] | None) -> list[int]:
    """Indices of the lines of the main text, given the lines' lengths, article levels and hashes and the sibling's hashes.

    Shared lines go unless they are marked; inside the article, a kind of mark further in goes when all its lines are shared
    and most of the article around it is the page's own: a box of the site, not a copied article."""
    every = range(len(sizes))
    shared = shared_lines(hashes, sibling) if sibling and sibling != hashes else set()   # an exact copy tells nothing about the frame
    own = [0 if i in shared else sizes[i] for i in every]
    best = article_level(sizes, levels)
    if best == OTHER:
        return [i for i in every if i not in shared]
    around = [i for i in every if levels[i] == best]
    boxes = set()
    if 2 * sum(own[i] for i in around) > sum(sizes[i] for i in around):
        boxes = {v for v in levels if v > best} - {levels[i] for i in every if own[i]}
    return [i for i in every if levels[i] >= best and levels[i] not in boxes]


def main_text(texts: list[str], levels: list[int], hashes: list[int], sibling: list[int] | None) -> str:
    return "\n".join(texts[i] for i in kept_lines([len(t) for t in texts], levels or [OTHER] * len(texts), hashes, sibling))


def url_order(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL, lower-cased host, without query and fragment."""
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    return (m[1].lower(), m[2]) if m else ("", re.split(r"[?#]", url or "")[0])


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` (lines joined by line feeds, empty if none), ``n_chars``.

    The page order is a range sort of (host, path, id), so a host with a third of all pages is spread
    over many tasks; the sibling of a page comes from a join on sort positions and only its line hashes
    travel. Null html gives an empty text; a null or relative URL belongs to the host "" and still gets a
    sibling there. Equal ids and whole repeated rows stay separate rows. Other columns are not read. An
    empty table gives an empty result. Pages are parsed once to order, pair and align them and once for their texts; html meets
    only the decisions of pages whose sibling changes the result, so where those are few nothing but hashes is shuffled.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html")).select(
        F.xxhash64("id", "url", "html").alias("k1"), F.xxhash64(F.lit(3), "html", "url", "id").alias("k2"), "id", "url", "html")
    key = ["k1", "k2"]                    # of a page row; rows that repeat id, url and html get the same result

    def described(batches):
        for b in batches:
            lines = [page_lines(h or "") for h in b.column(4).to_pylist()]
            where = [url_order(u) for u in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([w[0] for w in where], pa.string()), pa.array([w[1] for w in where], pa.string()),
                 pa.array([[_hash(t) for t, _ in r] for r in lines], pa.list_(pa.int64())),
                 pa.array([[v for _, v in r] for r in lines], pa.list_(pa.int8())),
                 pa.array([[len(t) for t, _ in r] for r in lines], pa.list_(pa.int32()))],
                names=[*key, "id", "host", "path", "hashes", "levels", "sizes"])

    about = materialize(rows.mapInArrow(described, f"k1 bigint, k2 bigint, id {kind}, host string, path string, hashes array<bigint>, "
                                                   "levels array<tinyint>, sizes array<int>"), "page-hashes")
    order = ["host", "path", "id", *key]
    # pages without lines and copies of a sibling's lines tell nothing about the frame: of a host's pages with equal lines the
    # first in order stands for all
    lined = about.where(F.size("hashes") > 0).withColumn("lines", F.xxhash64("hashes")).withColumn("marks", F.xxhash64("levels"))
    first = lined.groupBy("host", "lines").agg(F.min(F.struct("path", "id", *key)).alias("first"))
    ranked = materialize(first.select("host", "first.*", "lines").repartitionByRange(*order).sortWithinPartitions(*order)
                         .select(*key, "host", "path", "lines", F.spark_partition_id().alias("part"),
                                 F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "page-order")
    sizes = sorted(ranked.groupBy("part").count().collect())        # one row per partition of the sort
    before, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    if not offsets:
        offsets = [(0, 0)]
    base = spark.createDataFrame(offsets, "part int, before bigint")
    ranked = materialize(ranked.join(F.broadcast(base), "part").select(
        *key, "host", "path", "lines", (F.col("pos") + F.col("before")).alias("at")), "page-ranks")

    def neighbour(step: int, name: str) -> DataFrame:
        return ranked.select((F.col("at") + step).alias("at"), F.struct(*key).alias(f"{name}_key"), F.col("host").alias(f"{name}_host"),
                             F.col("path").alias(f"{name}_path"), F.col("lines").alias(f"{name}_lines"))

    def agree(name: str):
        """Length of the common path beginning, -1 on another host or for equal lines."""
        a, b = F.col("path"), F.col(f"{name}_path")
        n = F.least(F.length(a), F.length(b))
        differs = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.substr(a, k, F.lit(1)) != F.substr(b, k, F.lit(1)))
        return F.coalesce(F.when((F.col(f"{name}_host") == F.col("host")) & (F.col(f"{name}_lines") != F.col("lines")), F.coalesce(F.array_min(differs) - 1, n)), F.lit(-1))

    near = (ranked.join(neighbour(1, "prev"), "at", "left").join(neighbour(-1, "next"), "at", "left")
            .select("host", "lines", agree("prev").alias("p"), agree("next").alias("n"), "prev_key", "next_key")
            .select("host", "lines", F.when((F.col("p") >= F.col("n")) & (F.col("p") >= 0), F.col("prev_key"))
                    .when(F.col("n") >= 0, F.col("next_key")).alias("other")))
    hashes = about.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("hashes").alias("sibling")).dropDuplicates(["o1", "o2"])
    shared = materialize(near.select("host", "lines", F.col("other.k1").alias("o1"), F.col("other.k2").alias("o2")).join(hashes, ["o1", "o2"])
                         .select("host", "lines", "sibling"), "line-siblings")
    # of a host's pages with equal lines and marks, one is aligned for all; only its lines' hashes, marks and lengths travel
    kinds = lined.groupBy("host", "lines", "marks").agg(F.first(F.struct("hashes", "levels", "sizes")).alias("k"))

    def aligned(batches):
        """Kept lines of the pages for which the alignment decides otherwise than the page alone."""
        for b in batches:
            alone = [kept_lines(n, v, [], None) for n, v in zip(b.column(5).to_pylist(), b.column(4).to_pylist())]
            kept = [kept_lines(n, v, h, s) for h, v, n, s in zip(*(b.column(k).to_pylist() for k in (3, 4, 5, 6)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(kept, pa.list_(pa.int32()))], names=["host", "lines", "marks", "kept"]
                                             ).filter(pa.array([x != y for x, y in zip(alone, kept)], pa.bool_()))

    decided = materialize(kinds.join(shared, ["host", "lines"]).select("host", "lines", "marks", "k.*", "sibling")
                          .mapInArrow(aligned, "host string, lines bigint, marks bigint, kept array<int>"), "aligned-kinds")
    decided = materialize(lined.select(*key, "host", "lines", "marks").distinct().join(decided, ["host", "lines", "marks"])
                          .select(*key, "kept"), "aligned-pages")

    def extracted(batches):
        for b in batches:
            out = []
            for source, kept in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                lines = page_lines(source or "")
                texts = [t for t, _ in lines]
                out.append(main_text(texts, [v for _, v in lines], [], None) if kept is None else "\n".join(texts[i] for i in kept))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(out, pa.string())], names=["id", "url", "text"])

    texts = (rows.join(decided, key, "left").select("id", "url", "html", "kept")
             .mapInArrow(extracted, f"id {kind}, url string, text string"))
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                                      F.length("text").cast("bigint").alias("n_chars"))
