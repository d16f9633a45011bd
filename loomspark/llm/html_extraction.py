"""Main text of web pages by comparing each page with its nearest neighbour on the same host.

Pages are ordered by host and URL path; a page is paired with whichever neighbour in that order shares the longer
beginning of the path.  The text blocks ("lines") of both are aligned by a longest common subsequence, and blocks that both
pages have are template and are deleted.  What the markup itself says goes first: blocks inside elements that never hold
article text (menus, footers, forms, notices, adverts, comments ...) are not lines at all, and where a page
marks its article, the blocks inside are the article's own even if a neighbour repeats them; blocks outside are compared.
"""

from __future__ import annotations

import html as entities
import re
from array import array
from urllib.parse import urlsplit

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.common import map_rows, row_key
from loomspark.plans.scratch import written

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|[\s"'/])(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
SPLIT_NAME = re.compile(r"[^a-z0-9]+")

RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg object".split())
DROP = RAW | frozenset("head nav header footer aside form button select option dialog menu label input canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img math semantics mrow mi mn mo ms mtext msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()), "li": frozenset(["li"]), "option": frozenset(["option"])}
#: Words of class, id and role that mark an element as no article text.  A compound name that holds one, and a form, only make an
#: element doubtful: what it holds is looked at before it is dropped.
NOISE = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget widgets ad ads adv advert adverts advertisement "
    "advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social comment comments respond reply replies disqus related recommended recommendations pagination pager toolbar skip copyright contentinfo complementary search form dialog".split()
)
#: First words of names that tell a state of the page, as in ``has-sidebar``, and of names of parts of the article, as in ``post-header``.
STATES = frozenset("has with without no is js".split())
OWN = frozenset("article post entry story content".split())
#: Words that mark the article in pages without an element for it.
MAIN = frozenset(["articlebody", "main"])


def _holds_noise(token: str) -> bool:
    """Whether a class, id or role holds a noise word."""
    parts = [p for p in SPLIT_NAME.split(token) if p]
    if not parts or parts[0] in STATES or parts[0] in OWN and parts[-1] == "header":
        return False
    return any(p in NOISE for p in parts)


def _attributes(element: str, tag_text: str) -> tuple[bool, bool, bool]:
    """(noise, noise in a compound name, article) as class, id, role and the like say."""
    if HIDDEN.search(tag_text):
        return True, False, False
    noise = compound = article = False
    for name, *values in NAMED.findall(tag_text):
        tokens = "".join(values).lower().split()
        noise |= any(t in NOISE for t in tokens)
        compound |= element not in ("article", "main") and any(_holds_noise(t) for t in tokens)
        article |= name.lower() in ("role", "itemprop") and any(t in MAIN for t in tokens)
    return noise, compound, article


def _settled(found: list[tuple[str, bool, bool, int]], parents: list[int], holds: list[bool]) -> list[tuple[str, bool]]:
    """The blocks that stay when the doubtful elements are judged, outer ones first and of equal depth the larger first.

    One stays if it has most of the page's text, or if it holds an article or a main element and no text of such stands in what stays
    so far.  Without most of the text its article marks do not count.
    """
    if not parents:
        return [(text, inside) for text, inside, _, _ in found]
    sizes, total, seen = [0] * len(parents), 0, False
    bodies = [False] * len(parents)  # text of an article or main right inside
    for text, _, body, d in found:
        total += len(text)
        if d >= 0:
            sizes[d] += len(text)
            bodies[d] |= body
        else:
            seen |= body
    depths = []
    for p in parents:
        depths.append(depths[p] + 1 if p >= 0 else 0)
    for d in range(len(parents) - 1, -1, -1):
        if (p := parents[d]) >= 0:
            sizes[p] += sizes[d]
            holds[p] |= holds[d]
    stays, most = [False] * len(parents), [False] * len(parents)
    for d in sorted(range(len(parents)), key=lambda d: (depths[d], -sizes[d])):
        p = parents[d]
        if p >= 0 and not stays[p]:
            continue
        large = sizes[d] * 2 > total
        stays[d] = large or holds[d] and not seen
        most[d] = large and (p < 0 or most[p])
        seen |= stays[d] and bodies[d]
    return [(text, inside and (d < 0 or most[d])) for text, inside, _, d in found if d < 0 or stays[d]]


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """(text, inside the article) of each text block of a page in order; blanks are folded, empty blocks left out."""
    page = page or ""
    out: list[tuple[str, bool, bool, int]] = []
    buffer: list[str] = []
    # Name, dropped, in the article, in an article or main, and the doubtful element around, as a place in ``parents``.
    stack: list[tuple[str, bool, bool, bool, int]] = []
    outermost = (False, False, False, -1)
    dropped, inside, body, doubt = outermost
    parents: list[int] = []  # the doubtful element around each doubtful one
    holds: list[bool] = []  # whether it holds an article or main

    def flush() -> None:
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append((text, inside, body, doubt))

    def pop_to(depth: int) -> None:
        nonlocal dropped, inside, body, doubt
        flush()
        del stack[depth:]
        dropped, inside, body, doubt = stack[-1][1:] if stack else outermost

    at, end = 0, len(page)
    where: dict[str, list[int]] = {}  # depths at which a name is open
    while at < end:
        m = TOKEN.search(page, at)
        if not dropped:
            buffer.append(page[at : m.start() if m else end])
        if m is None:
            break
        at = m.end()
        closing, name = m[1], (m[2] or "").lower()
        if not name:
            continue
        if closing:
            open_at = where.get(name)
            while open_at and (open_at[-1] >= len(stack) or stack[open_at[-1]][0] != name):
                open_at.pop()
            if open_at and (name not in INLINE):
                pop_to(open_at.pop())
            elif name in INLINE and open_at and open_at[-1] == len(stack) - 1:
                was = dropped
                stack.pop()
                open_at.pop()
                dropped, inside, body, doubt = stack[-1][1:] if stack else outermost
                if was and not dropped:
                    buffer.append(" ")
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            if not m[3].endswith("/") or name != "svg":
                at = close.end() if close else end
            if name not in INLINE:
                flush()
            continue
        if name not in INLINE:
            flush()
            while stack and stack[-1][0] in INLINE and not stack[-1][1]:  # a block ends what is inline and left open
                stack.pop()
            if stack and name in CLOSED_BY.get(stack[-1][0], ()):
                pop_to(len(stack) - 1)
        if name in VOID:
            continue
        noise, compound, marked = _attributes(name, m[3]) if m[3] else (False, False, False)
        if name in ("html", "body"):
            noise = compound = False
        if name in INLINE:
            noise, compound = noise or compound, False
        article = name == "article" or marked
        if name in HEADINGS and inside and any(s[0] == "header" for s in stack[-2:]) and not noise:
            drop = False  # the title of an article may stand in a header of its own
        else:
            drop = dropped or noise or name in DROP and name != "form"
        if m[3].endswith("/") and name not in ("a",) and m[3][-2:-1] in ("", " "):
            continue
        where.setdefault(name, []).append(len(stack))
        around = doubt
        if not drop and (compound or name == "form"):
            parents.append(doubt)
            holds.append(False)
            around = len(parents) - 1
        of_body = article or name == "main"
        if of_body and not drop and around >= 0:
            holds[around] = True
        stack.append((name, drop, (inside or article) and not noise, (body or of_body) and not noise, around))
        dropped, inside, body, doubt = stack[-1][1:]
    flush()
    return _settled(out, parents, holds)


def line_key(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def shared(a: list[int], b: list[int]) -> list[bool]:
    """For each line of ``a``, whether a longest common subsequence with ``b`` holds it (of several, the one that starts first)."""
    n, m, head = len(a), len(b), 0
    while head < n and head < m and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and tail < m - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    both = set(a[head : n - tail]) & set(b[head : m - tail])
    left = [i for i in range(head, n - tail) if a[i] in both]
    right = [x for x in b[head : m - tail] if x in both]
    out = [True] * head + [False] * (n - head - tail) + [True] * tail
    for k in _aligned([a[i] for i in left], right):
        out[left[k]] = True
    return out


def _row(a: list[int], b: list[int]) -> int:
    """Last row of the length table as bits: a zero at j where the length grows from b[:j] to b[:j+1]."""
    masks: dict[int, int] = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & masks.get(x, 0)
        v = (v + u | v - u) & full
    return v


def _aligned(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence: halves of ``a`` are joined at the best place of ``b``; rows are bit sets."""
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            if a[a0] in b[b0:b1]:
                out.append(a0)
            continue
        mid = (a0 + a1) // 2
        part = b[b0:b1]
        ahead = _row(a[a0:mid], part)
        back = _row(a[mid:a1][::-1], part[::-1])
        n = b1 - b0
        ups = array("l", [0])
        for bit in reversed(bin(ahead | 1 << n)[3:]):
            ups.append(ups[-1] + (bit == "0"))
        best, at, down = -1, 0, 0
        bits = bin(back | 1 << n)[:2:-1]
        for j in range(n, -1, -1):
            if j < n:
                down += bits[n - 1 - j] == "0"
            if ups[j] + down >= best:
                best, at = ups[j] + down, j
        todo += [(mid, a1, b0 + at, b1), (a0, mid, b0, b0 + at)]
    return out


def address(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL; a URL that cannot be read is a host of its own kind with the URL as path."""
    url = url or ""
    try:
        parts = urlsplit(url)
        return (parts.netloc.rpartition("@")[2].lower(), parts.path) if parts.netloc else ("", url)
    except ValueError:
        return "", url


def _hasher():
    return lambda key, url, page: (key, *address(url), [line_key(t) for t, _ in blocks(page)])


def _reader():
    def row(key, page_id, url, page):
        return key, page_id, url, [{"text": t, "inside": i, "line": line_key(t)} for t, i in blocks(page)]

    return row


def _writer():
    def row(page_id, url, lines, mate):
        drop = shared([x["line"] for x in lines], mate) if mate else [False] * len(lines)
        # A mate without a common line says nothing about the template; then a mark decides alone.
        alone = any(x["inside"] for x in lines) and not any(drop)
        text = " ".join(x["text"] for x, d in zip(lines, drop) if x["inside"] or not alone and not d)
        return page_id, url, text

    return row


def _prefix(a, b):
    """Length of the common beginning of two paths, in whole segments."""
    pairs = F.zip_with(F.split(a, "/"), F.split(b, "/"), lambda x, y: F.coalesce(x == y, F.lit(False)))
    same = F.transform(pairs, lambda p, i: F.when(~p, i))
    return F.coalesce(F.array_min(same), F.size(pairs))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url and text of each row of ``pages``, in which blocks are joined by one space.

    Null or empty html gives an empty text, and a null URL stands for a host of its own; null ids stay.
    Rows that repeat are pages like any others and give a row each.  Of two neighbours that are equally near the one before
    is taken; copies are passed over, so they never delete each other; a host of copies, or of one page, has nothing to compare with.  An empty table gives an empty table, and other
    columns are not read.  Only keys, paths and line hashes are dealt out by host and URL, in ranges, so a
    host of any size is spread over all tasks; a page meets the line hashes of one other page.
    """
    key = row_key(F.col(page_id), F.xxhash64(url), F.xxhash64(html))
    rows = pages.select(key.alias("key"), F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    # Texts are read twice, once for their hashes and once for themselves, and are written nowhere in between.
    read = written(map_rows(rows.select("key", "url", "html"), _hasher, "key string, host string, path string, lines array<long>"), "pages")
    places = read.groupBy("host", "path", "key").agg(F.first(F.xxhash64("lines")).alias("sequence"))  # copies of a row are one place
    order = ["host", "path", "key"]
    place = F.struct(*order, "sequence")
    # A page with the same lines says nothing either: a neighbour is the nearest of other lines, or of another host, where the search ends.
    other = lambda a, b: (a["host"] != b["host"]) | (a["sequence"] != b["sequence"])

    def nearest(beside, order_of):
        """The nearest place before, in an order, that is other than each row's own; ``beside`` is the row just before."""
        return F.last(beside, ignorenulls=True).over(order_of.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    dealt = written(places.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "places")
    # What misses a neighbour in its partition looks for it in the rows at the ends of the others, two for each end.
    ends = dealt.groupBy("part").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    ends = dealt.join(F.broadcast(ends), "part").groupBy("part", "first", "last").agg(
        F.max(F.when(other(place, F.col("last")), place)).alias("last_other"),
        F.min(F.when(other(place, F.col("first")), place)).alias("first_other"),
    )
    up, down = Window.orderBy("part"), Window.orderBy(F.desc("part"))
    ends = ends.withColumn("before_part", F.lag("last").over(up)).withColumn("after_part", F.lag("first").over(down))
    beside = lambda c, own: F.when(other(F.col(c), F.col(own)), F.col(c))
    ends = ends.withColumn("last_other", nearest(F.coalesce("last_other", beside("before_part", "last")), up))
    ends = ends.withColumn("first_other", nearest(F.coalesce("first_other", beside("after_part", "first")), down))
    ends = ends.select("part", "before_part", "after_part", F.lag("last_other").over(up).alias("before_other"), F.lag("first_other").over(down).alias("after_other"))
    ways = {"before": Window.partitionBy("part").orderBy(*order), "after": Window.partitionBy("part").orderBy(*[F.desc(c) for c in order])}
    near = dealt.withColumn("own", place)
    for way, window in ways.items():
        near = near.withColumn(way, F.lag("own").over(window))
        near = near.withColumn(way, nearest(beside(way, "own"), window))
    near = near.join(F.broadcast(ends), "part").select(
        *order,
        *[F.coalesce(way, F.when(other(F.col(f"{way}_part"), F.col("own")), F.col(f"{way}_part")).otherwise(F.col(f"{way}_other"))).alias(way) for way in ways],
    )
    score = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), _prefix(F.col(f"{c}.path"), F.col("path")))
    near = near.withColumn("s", score("before")).withColumn("t", score("after"))
    mate = F.when(F.col("t") > F.coalesce("s", F.lit(-1)), F.col("after.key")).when(F.col("s").isNotNull(), F.col("before.key"))
    mates = near.select("key", mate.alias("mate"))
    lines = read.groupBy("key").agg(F.first("lines").alias("mate_lines"))
    pairs = mates.filter("mate IS NOT NULL").join(lines.withColumnRenamed("key", "mate"), "mate").select("key", "mate_lines")
    full = map_rows(rows, _reader, "key string, page_id long, url string, lines array<struct<text:string,inside:boolean,line:long>>")
    met = full.join(pairs, "key", "left").select("page_id", "url", "lines", "mate_lines")
    return map_rows(met, _writer, "page_id long, url string, text string")
