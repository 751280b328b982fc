"""Main text of web pages: nearest-URL page differencing.

Pages are ordered by host and URL path, and each is paired with its nearest page of the same host that has other
text: the next one, or the one before for the last of a host. The text lines of the two are aligned by a longest
common subsequence, and lines that both have are template lines: they are deleted. Neighbours without an article
whose unmarked lines are the same but for a small share are copies; a run of copies is paired with the first page
after it, or the last one before it, and loses nothing if the host has no other page.

Differencing alone errs in two ways, so markup decides where it is plain. Articles under neighbouring URLs can
share lines: lines within an ``article`` or ``main`` element are never deleted. And menus or adverts that vary from page to page share none: lines within elements that are menus,
headers, footers, sidebars, notices, adverts, forms or comments by their tag, role, class or id always
are, and so is what stands outside the article of a page that has one. On a page without such an
element the alignment decides.

A class, id or role is judged token by token. A token marks an element if it begins or ends with the name of
such a thing and tells no state ("no-sidebar", "comments-open"). Within an article every part of the token must be such a
name or a word of layout ("share-buttons" marks, "related-work" does not), and ids of headings, which name their section,
do not count. A marked inline element takes its own text out of a block, not what follows. ``html``, ``body``, ``article`` and ``main`` are
never marked by their names. An article within an element that its name marks counts unless another article stands
outside of such elements, or it is a reply within an article.

Defined results: a null or empty page has an empty text. A host with one page has nothing to compare it
with, so only markup decides. A null or unusual URL is its own host. Repeated rows each get their result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.ranges import range_of, shuffle_partitions

# Element names of HTML by their role.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "select", "canvas"}
BOILERPLATE = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    "nobr", "object", "picture", "ruby", "rt", "rp", "svg", "g", "text", "tspan",
    "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "msub", "msup", "msubsup", "mfrac", "msqrt", "mroot",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NESTED = {
    "div", "section", "ul", "ol", "dl", "table", "tbody", "thead", "tr", "td", "th", "blockquote", "figure", "fieldset",
    "details", "center", "body", "html", *MAIN, *BOILERPLATE,
}
MARKS = {
    "ad", "ads", "advert", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "aside",
    "footer", "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter",
    "subscribe", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment", "comments",
    "disqus", "contentinfo", "search", "complementary", "skip",
}

# parts of names that say how a page is laid out or what it allows, not what an element is
STATES = {
    "no", "not", "non", "without", "with", "has", "have", "is", "one", "two", "both", "free", "open", "opened", "closed", "enabled",
    "disabled", "active", "inactive", "visible", "hidden", "collapsed", "expanded", "allowed", "layout",
}
# Words of layout that stand beside a mark in a name and do not change what it says
LAYOUT_WORDS = {
    "area", "article", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "col", "column", "container",
    "content", "entry", "form", "global", "group", "header", "icon", "icons", "inner", "item", "items", "label", "left", "link",
    "links", "list", "main", "outer", "page", "panel", "post", "posts", "primary", "reader", "respond", "right", "row",
    "secondary", "section", "single", "site", "slot", "stories", "story", "thread", "title", "toolbar", "tools", "top", "unit",
    "user", "widget", "widgets", "wrap", "wrapper",
}
LAYOUTS = {frozenset({"content", "sidebar"}), frozenset({"main", "sidebar"})}
# their name never marks these, and nothing marks the first two
WHOLE = {"html", "body"}

# neighbours that share so many per cent of the characters of their unmarked lines are copies
COPY_PERCENT = 95

# a quote opens a value only right after an equals sign; elsewhere it is a character like any other
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PARTS = re.compile(r"[a-z]+")

# WRAPPED is an article within an element that its name marks, where no article stands outside of those
OUTSIDE, IN_MAIN, MARKED, WRAPPED = 0, 1, 2, 3
# within an element that is marked by its name only; such lines are MARKED
_NAMED = 4


def _names_boilerplate(token: str, in_article: bool) -> bool:
    """Whether a class, id or role is a mark, or begins or ends with one and tells no state.

    Within an article its other parts must be marks or words of layout.
    """
    parts = _PARTS.findall(token)
    if not parts or not STATES.isdisjoint(parts) or (len(parts) > 1 and frozenset(parts) in LAYOUTS):
        return False
    if in_article:
        return not MARKS.isdisjoint(parts) and all(x in MARKS or x in LAYOUT_WORDS for x in parts)
    return parts[0] in MARKS or parts[-1] in MARKS


def _marked(attributes: str, element: str, in_article: bool) -> int:
    """MARKED if the element is not shown, ``_NAMED`` if its class, id or role is boilerplate, else OUTSIDE."""
    found = OUTSIDE
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return MARKED
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return MARKED
        elif name in ("class", "id", "role") and not (name == "id" and in_article and element in HEADINGS):
            if any(_names_boilerplate(x, in_article) for x in value.split()):
                found = _NAMED
    return found


def page_lines(page: str) -> list[tuple[str, int]]:
    """The non-empty text blocks of a page in order, each with where it stands."""
    lines: list[tuple[str, int]] = []
    parts: list[str] = []
    # open elements that matter, as (name, state within, and for a marked inline element the block it interrupts)
    stack: list[tuple[str, int, list[str] | None]] = []
    state = OUTSIDE
    lower = None
    article_outside = False

    def end_line() -> None:
        nonlocal article_outside
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                lines.append((text, MARKED if state == _NAMED else state))
                article_outside |= state == IN_MAIN and any(x[0] == "article" for x in stack)
            parts.clear()

    def leave(depth: int) -> None:
        """End the elements that are open beyond ``depth``; a block that an inline element interrupts goes on."""
        nonlocal state
        while len(stack) > depth:
            _, _, interrupted = stack.pop()
            outer = stack[-1][1] if stack else OUTSIDE
            if interrupted is not None:
                end_line()
                parts.extend(interrupted)
            elif outer != state:
                end_line()
            state = outer

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            # a reference does not go on behind a tag
            parts.append(html.unescape(page[at : m.start()]))
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            # the innermost open element of that name; an inline one does not end the blocks around it
            depth = len(stack) - 1
            while depth >= 0 and stack[depth][0] != name:
                depth = -1 if name in INLINE and stack[depth][0] not in INLINE else depth - 1
            if name in INLINE:
                if depth >= 0:
                    leave(depth)
                continue
            leave(depth + 1 if depth >= 0 else len(stack))
            end_line()
            if depth >= 0:
                leave(depth)
            continue
        if name in RAW and not m[3].endswith("/"):
            if name != "textarea":
                end_line()
            if lower is None:
                lower = page.lower()
            close = lower.find(f"</{name}", at)
            close = len(page) if close < 0 else close
            end = page.find(">", close)
            at = len(page) if end < 0 else end + 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        inline = name in INLINE
        within_main = any(x[0] in MAIN for x in stack)
        marked = _marked(m[3], name, within_main) if m[3] and name not in WHOLE else OUTSIDE
        if name in MAIN and marked == _NAMED:
            marked = OUTSIDE
        if inline and not marked:
            # within a marked inline element its own name may stand again
            if stack and stack[-1][0] in INLINE and name not in VOID and not m[3].endswith("/"):
                stack.append((name, state, None))
            continue
        if not inline:
            end_line()
        if name in VOID or (inline and m[3].endswith("/")):
            continue
        # marked elements that are left open: a paragraph ends where a block begins, an item at the next one
        if not inline:
            while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p" or stack[-1][0] == name == "li"):
                leave(len(stack) - 1)
            end_line()
        interrupted = None
        if inline:
            # a marked inline element: its text belongs to no line of the article
            interrupted = parts[:]
            parts.clear()
        if state == MARKED or marked == MARKED:
            inner = MARKED
        elif marked:
            inner = _NAMED
        elif name in MAIN and state in (_NAMED, WRAPPED):
            # a reply within an article stays what it is
            inner = state if any(x[0] == "article" for x in stack) else WRAPPED
        elif name == "header" and within_main:
            # the head of an article holds its title
            inner = state
        elif name in BOILERPLATE:
            inner = MARKED
        elif name in MAIN:
            inner = IN_MAIN
        else:
            inner = state
        if name in NESTED or marked:
            stack.append((name, inner, interrupted))
            state = inner
    leave(0)
    end_line()
    if article_outside:
        return [(text, MARKED if state == WRAPPED else state) for text, state in lines]
    return lines


def shared_lines(a: list, b: list) -> set[int]:
    """The places in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Common ends match at once. The rest is one bit vector over ``b`` for each line of ``a``; every so many
    of them are kept and those between are made again on the way back, which bounds memory for long pages.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(head), *range(len(a) - tail, len(a))}
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    places: dict = {}
    for j, line in enumerate(y):
        places[line] = places.get(line, 0) | 1 << j
    kept = [i for i, line in enumerate(x) if line in places]
    if not kept:
        return found
    ones = (1 << len(y)) - 1
    step = max(1, int(len(kept) ** 0.5))

    def advance(v: int, i: int) -> int:
        u = v & places[x[kept[i]]]
        return ((v + u) | (v - u)) & ones

    marks, v = [ones], ones
    for i in range(len(kept)):
        v = advance(v, i)
        if (i + 1) % step == 0:
            marks.append(v)
    j = len(y)
    block = (len(kept) - 1) // step
    end = len(kept)
    while block >= 0 and j > 0:
        rows = [marks[block]]
        for i in range(block * step, end):
            rows.append(advance(rows[-1], i))
        for i in range(end - 1, block * step - 1, -1):
            before, after = rows[i - block * step], rows[i - block * step + 1]
            # zero bits up to j count the common subsequence; step left while it stays the same
            while j > 0 and (after >> (j - 1)) & 1:
                j -= 1
            if j == 0:
                break
            if (before >> (j - 1)) & 1:
                found.add(head + kept[i])
                j -= 1
        end, block = block * step, block - 1
    return found


def unmarked_lines(lines: list[str], states: bytes) -> tuple[list[int], list[int]] | None:
    """Hashes and lengths of the lines that an alignment may delete; None for a page with an article, which loses none."""
    if IN_MAIN in states:
        return None
    own = [line for line, state in zip(lines, states, strict=True) if state == OUTSIDE]
    hashes = [int.from_bytes(blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) for line in own]
    return hashes, [len(line) for line in own]


def copies(a: tuple[list[int], list[int]] | None, b: tuple[list[int], list[int]] | None) -> bool:
    """Whether the unmarked lines of two pages without an article are the same but for a small share."""
    if a is None or b is None:
        return False
    length = dict(zip(a[0], a[1], strict=True))
    both = sum(length[h] * n for h, n in (Counter(a[0]) & Counter(b[0])).items())
    return 100 * both >= COPY_PERCENT * max(sum(a[1]), sum(b[1]))


def main_text(lines: list[str], states: bytes, shared: set[int]) -> str:
    """The lines of the article where there is one, else those outside marked elements that are not shared.

    Articles in elements that are marked by their name come with either.
    """
    wanted = IN_MAIN if IN_MAIN in states else OUTSIDE
    return " ".join(
        line
        for i, line in enumerate(lines)
        if states[i] == WRAPPED or (states[i] == wanted and (wanted == IN_MAIN or i not in shared))
    )


def url_key(url: str | None) -> tuple[str, str]:
    """Host and path; the query and fragment only name views of a page."""
    try:
        parts = urlsplit(url or "")
        return parts.netloc.lower(), parts.path
    except ValueError:
        return url or "", ""


_KEYS = "host string, path string, missing int, id bigint, tie bigint"
_DEALT = f"bucket int, role int, {_KEYS}, page_id bigint, url string, lines array<string>, states binary"
# the unmarked lines of a page without an article, and null for others
_LINED = f"bucket int, {_KEYS}, hashes array<bigint>, lengths array<bigint>"
# of a range: a page, and which one it is
_MARKS = f"bucket int, place int, {_KEYS}, hashes array<bigint>, lengths array<bigint>"
# the range's first and last page, the first page of its second run, and the last page of its last run but one
FIRST, LAST, SECOND_RUN, RUN_BEFORE = 0, 1, 2, 3
LEAD, BODY, TAIL = -1, 0, 1


def beyond(marks: dict[int, dict[int, tuple[tuple, tuple | None]]]) -> list[tuple[tuple, int, int]]:
    """The pages that ranges need from others, as (key, range, role).

    ``marks`` has for each range its marked pages as (key, unmarked lines). Each range needs the last page of the run
    before its first run, and the first page of the run after its last one, if they are of the same host.
    """
    ranges = sorted(marks)

    def joined(a: int, b: int) -> bool:
        (x, own), (y, other) = marks[a][LAST], marks[b][FIRST]
        return x[0] == y[0] and copies(own, other)

    out = []
    for i, at in enumerate(ranges):
        for role, step, near, far, inner in ((LEAD, -1, FIRST, LAST, RUN_BEFORE), (TAIL, 1, LAST, FIRST, SECOND_RUN)):
            here, j = at, i + step
            while 0 <= j < len(ranges):
                there = ranges[j]
                page = marks[there][far]
                if joined(there, here) if role == LEAD else joined(here, there):
                    # a run that goes on: what follows it within that range, or the range after
                    page = marks[there].get(inner)
                    here, j = there, j + step
                    if page is None:
                        continue
                if page[0][0] == marks[at][near][0][0]:
                    out.append((page[0], at, role))
                break
    return out


def extract(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    Pages are cut into ranges of (host, path); each range also gets the first page of the run after it and the last
    one of the run before it, so that a host of any size is spread over tasks and its result does not depend on the
    ranges. Each page's lines are shuffled once, and before that hashes of the unmarked lines of pages without an article.
    """
    ident = pages[id_col].cast("bigint")
    given = pages.select(
        ident.alias("page_id"),
        pages[url_col].alias("url"),
        pages[html_col].alias("html"),
        ident.isNull().cast("int").alias("missing"),
        F.coalesce(ident, F.lit(0).cast("bigint")).alias("id"),
    )

    def key_rows(batch: pa.RecordBatch) -> list[tuple]:
        ties = batch.column("tie").to_pylist()
        ids, missing = batch.column("id").to_pylist(), batch.column("missing").to_pylist()
        # the order of UTF-8 bytes, as Spark sorts
        keys = [url_key(u) for u in batch.column("url").to_pylist()]
        return [(h.encode("utf-8", "replace"), p.encode("utf-8", "replace"), m, i, t) for (h, p), m, i, t in zip(keys, missing, ids, ties, strict=True)]

    def keys_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([(h.decode(), p.decode(), *rest) for h, p, *rest in key_rows(batch)], _KEYS)

    tied = given.withColumn("tie", F.xxhash64("html"))
    names = ["host", "path", "missing", "id", "tie"]
    parts = shuffle_partitions(pages)
    bounds = (
        tied.select("url", "missing", "id", "tie")
        .mapInArrow(keys_only, _KEYS)
        .repartitionByRange(parts, *names)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(F.struct(*names)).alias("first"))
    ).collect()
    as_key = lambda r: (r[0].encode(), r[1].encode(), *r[2:])
    starts = sorted(as_key(r["first"]) for r in bounds)

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, page in zip(key_rows(batch), batch.column("html").to_pylist(), strict=True):
                found = page_lines(page or "")
                own = unmarked_lines([t for t, _ in found], bytes(x for _, x in found))
                rows.append((range_of(starts, key), key[0].decode(), key[1].decode(), *key[2:], *(own or (None, None))))
            yield _batch(rows, _LINED)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, found = None, {}

        def ended() -> pa.RecordBatch:
            found[LAST] = before
            return _batch([(row["bucket"], place, *(row[c] for c in (*names, "hashes", "lengths"))) for place, row in found.items()], _MARKS)

        for batch in batches:
            for row in batch.to_pylist():
                if before is None or row["bucket"] != before["bucket"]:
                    if before is not None:
                        yield ended()
                    found = {FIRST: row}
                elif row["host"] != before["host"] or not copies(_own(before), _own(row)):
                    found.setdefault(SECOND_RUN, row)
                    found[RUN_BEFORE] = before
                before = row
        if before is not None:
            yield ended()

    outlines = tied.mapInArrow(outline, _LINED).repartitionById(parts, "bucket").sortWithinPartitions("bucket", *names)
    marks: dict[int, dict[int, tuple]] = {}
    for r in outlines.mapInArrow(mark, _MARKS).collect():
        marks.setdefault(r["bucket"], {})[r["place"]] = as_key([r[c] for c in names]), _own(r)
    needs: dict[tuple, list[tuple[int, int]]] = {}
    for key, bucket, role in beyond(marks):
        needs.setdefault(key, []).append((bucket, role))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
            for key, page_id, url, page in zip(key_rows(batch), *columns, strict=True):
                found = page_lines(page or "")
                lines, states = [t for t, _ in found], bytes(s for _, s in found)
                for bucket, role in [(range_of(starts, key), BODY), *needs.get(key, ())]:
                    rows.append((bucket, role, key[0].decode(), key[1].decode(), *key[2:], page_id, url, lines, states))
            yield _batch(rows, _DEALT)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last page of the run before, and the pages of the run with the unmarked lines of the last one
        before, run, own = None, [], None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                mine = unmarked_lines(row["lines"], row["states"])
                last = run[-1] if run else None
                together = last is not None and (last["bucket"], last["host"], last["role"]) == (row["bucket"], row["host"], row["role"])
                if not (together and copies(own, mine)):
                    out += results(before, run, row)
                    before, run = last, []
                run.append(row)
                own = mine
            yield result_batch(out)
        yield result_batch([*results(before, run, None)])

    def results(before: dict | None, run: list[dict], after: dict | None) -> Iterator[tuple]:
        if not run or run[0]["role"] != BODY:
            return
        beside = lambda x: x is not None and x["bucket"] == run[0]["bucket"] and x["host"] == run[0]["host"]
        mate = after if beside(after) else before if beside(before) else None
        for here in run:
            # an article loses no lines
            aligned = mate is not None and IN_MAIN not in here["states"]
            shared = shared_lines(here["lines"], mate["lines"]) if aligned else set()
            yield here["page_id"], here["url"], main_text(here["lines"], here["states"], shared)

    def result_batch(rows: list[tuple]) -> pa.RecordBatch:
        ids, urls, texts = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, type=pa.int64()),
                pa.array(urls, type=pa.string()),
                pa.array(texts, type=pa.string()),
                pa.array([len(t) for t in texts], type=pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )

    dealt = tied.mapInArrow(deal, _DEALT).repartitionById(parts, "bucket")
    return dealt.sortWithinPartitions("bucket", "role", *names).mapInArrow(
        walk, "page_id bigint, url string, text string, n_chars bigint"
    )


def _own(row) -> tuple[list[int], list[int]] | None:
    return None if row["hashes"] is None else (row["hashes"], row["lengths"])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {
        "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()),
        "array<bigint>": pa.list_(pa.int64()), "binary": pa.binary(),
    }
    fields = [c.split() for c in ddl.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields]
    )
