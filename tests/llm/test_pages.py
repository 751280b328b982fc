"""Main text of pages, and WARC archives."""

import base64
import gzip
import hashlib
import random

import pytest

from millrace.llm import html_text, warc

PAGES = "page_id bigint, url string, html string"


def lcs(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i + 1][j + 1] = d[i][j] + 1 if x == y else max(d[i][j + 1], d[i + 1][j])
    return d[-1][-1]


@pytest.mark.parametrize("seed", range(4))
def test_shared_lines_are_a_longest_common_subsequence(seed):
    r = random.Random(seed)
    for _ in range(300):
        a = [r.choice("abcde"[: r.randint(1, 5)]) for _ in range(r.randint(0, 25))]
        b = [r.choice("abcde") for _ in range(r.randint(0, 25))]
        found = html_text.shared_lines(a, b)
        rest = iter(b)
        assert len(found) == lcs(a, b) and all(a[i] in rest for i in sorted(found))


def test_long_pages_of_one_line():
    assert len(html_text.shared_lines(["x"] * 5000 + ["y"], ["z"] + ["x"] * 3000)) == 3000


def text_of(page):
    lines = html_text.page_lines(page)
    return html_text.main_text([t for t, _ in lines], bytes(s for _, s in lines), set())


def test_markup():
    page = """<!DOCTYPE html><html><head><title>T &lt;</title><style>p{}</style><script>var t="</p><article>";</script></head>
    <body class="home"><header>Site</header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="ad">Buy</div>
    <div id=cookie-notice>Cookies!</div><aside>Side</aside><form>Mail <input name=q></form>
    <article><header><h1>Head&shy;line</h1></header><p>One <b>bo</b>ld<br>line &amp;amp; &#233;&nbsp;x<!-- <p>no</p> --></p><p>Two
    <p class='ad'>Spot</p><div class="promo box">P <div>Q</div> R</div><ul><li>i<li>j</ul>
    <p hidden>h</p><section class="comments"><p>First!</p><article>Reply</article></section><p>a < b &amp c</article>
    <footer>&copy; me</footer>"""
    assert text_of(page) == "Head­line One bold line &amp; é x Two i j a < b & c"


@pytest.mark.parametrize(
    "page",
    [
        '<body class="no-sidebar"><p>The text</p></body>',
        '<body class="home sidebar" hidden><p>The text</p></body>',
        '<html class="menu-open no-ads"><body id="search"><div class="content with-sidebar">The text</div>',
        '<article class="post comments-open"><p>The text</p></article>',
        '<main id="search" role="search"><p>The text</p></main>',
        '<div class="content-sidebar social-proof-free"><p>The text</p></div>',
        '<div class="sidebar-left"><main><nav>N</nav><p>The text</p></main></div>',
        '<div class="sidebar"><p>Side</p><article><h1>The</h1><p>text</p><div class="comments"><article>Re</article></div></article></div>',
        '<article>The text</article><div id="comments"><article>Reply</article></div><div class="site-footer">F</div>',
        '<div class="related"><article>Teaser</article></div><main><article>The text</article></main>',
        '<div class="sidebar" hidden><article>Hidden</article></div><div>The text</div>',
        '<div class="post-comments">First!</div><div class="Cookie-Notice x">C</div><div>The text</div><div class="ad2">Ad</div>',
    ],
)
def test_names_of_layouts_do_not_drop_the_text(page):
    assert text_of(page) == "The text"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<p>Hello <a class="share">Tweet</a> and goodbye.</p>', "Hello and goodbye."),
        ('<p>one<span class=ad>x<span>y</span>z</span>two <b>three</b></p><p>four</p>', "onetwo three four"),
        ('<p>open <a class="share">Tweet</p><p>next</p>', "open next"),
        ('<p>open <a class="share">Tweet<div>block</div></p> next', "open block next"),
        ("<p class=it's>Hello</p><p class='a'b\">you</p>", "Hello you"),
        ("<p>see <a title=Bob's href=x>this</a>, <a href=\"a>b\" title='class=ad hidden'>that</a></p>", "see this, that"),
        ('<h2 id="comments">On comments</h2><h3 id="search">Search</h3>', "On comments Search"),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, <svg><title>t</title><text>drawn</text></svg> <object>kept</object></p>", "so x=1, drawn kept"),
        ("<p>&<b>lt;</b> &l<!-- -->t; &lt;</p>", "&lt; &lt; <"),
        ('<div class="share-buttons">S</div><div class="related-posts">R</div><ul id="comment-list"><li>C</ul>kept', "kept"),
        *[
            (f'<section {attribute}="{name}"><p>kept</p></section>', "kept")
            for attribute in ("id", "class")
            for name in ("related-work", "notice-of-appeal", "ad-hoc", "modal-logic", "skip-level", "search-results-analysis")
        ],
    ],
)
def test_an_article_keeps_its_text(page, text):
    assert text_of(f"<nav>N</nav><article>{page}</article><footer>F</footer>") == text


@pytest.mark.parametrize("page", ["", "<", "<p", "a<b", "<script>", "<!--", "</p></div>", "<a title='x>y", "<p>x</p", "&#xZZ;&amp"])
def test_broken_markup_does_not_fail(page):
    assert isinstance(text_of(page), str)


def test_pages_without_an_article_lose_the_lines_they_share(spark):
    page = lambda body: f"<body><div>Menu</div><div>{body}</div><div>Imprint</div></body>"
    rows = [
        (1, "http://a.com/x/1", page("one")),
        (2, "http://A.com/x/2?q=1", page("two")),
        (3, "http://a.com/y", page("three")),
        (4, "http://b.com/", page("alone")),
        (5, None, None),
        (6, "http://[bad", ""),
        (7, "http://c.com/1", "<nav>n</nav><article><p>same</p></article>"),
        (8, "http://c.com/2", "<nav>n</nav><article><p>same</p></article>"),
        (8, "http://c.com/2", "<nav>n</nav><article><p>same</p></article>"),
    ]
    out = html_text.extract(spark.createDataFrame(rows, PAGES).repartition(4), "page_id", "url", "html").collect()
    got = sorted((r.page_id, r.text, r.n_chars) for r in out)
    texts = {1: "one", 2: "two", 3: "three", 4: "Menu alone Imprint", 5: "", 6: "", 7: "same", 8: "same"}
    assert got == sorted((i, texts[i], len(texts[i])) for i, _, _ in rows)
    assert {r.page_id: r.url for r in out} == {i: u for i, u, _ in rows}


def test_hosts_spread_over_ranges_pair_with_their_neighbours(spark):
    rows = [(i, f"http://h{i % 3}.com/p{i:03}", f"<div>T{i % 3}</div><div>body {i}</div><div>F</div>") for i in range(120)]
    out = html_text.extract(spark.createDataFrame(rows, PAGES).repartition(5), "page_id", "url", "html").collect()
    assert sorted((r.page_id, r.text) for r in out) == [(i, f"body {i}") for i in range(120)]


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_copies_under_neighbouring_urls_keep_their_text(spark, parts):
    page = lambda body, note="": f"<div>Menu of the site</div><div>{body}</div><div>Imprint</div><p>{note}</p>"
    long = "A long text that several addresses show, word by word, with nothing else that would set them apart. " * 2
    rows, want = [], {}

    def add(url, body, note="", kept=None):
        rows.append((len(rows), url, page(body, note)))
        want[len(want)] = " ".join((kept or f"{body} {note}").split())

    for i in range(30):
        add(f"http://a.com/b{i:02}", long)
    add("http://a.com/a", "First")
    add("http://a.com/c", "Last")
    # copies but for a number, first and last of their host
    for i in range(25):
        add(f"http://b.com/{i:02}", long, f"{i}")
    add("http://b.com/x", "Other")
    for i in range(25):
        add(f"http://b.com/y{i:02}", long.upper(), f"{i}")
    # a host that has nothing else
    for i in range(20):
        add(f"http://c.com/{i}", long, kept=f"Menu of the site {long} Imprint")
    given = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = html_text.extract(spark.createDataFrame(rows, PAGES).repartition(5), "page_id", "url", "html").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", given)
    assert {r.page_id: r.text for r in out} == want and len(out) == len(rows)


def test_no_pages(spark):
    empty = spark.createDataFrame([], PAGES)
    assert html_text.extract(empty, "page_id", "url", "html").count() == 0
    assert warc.archived(empty, "page_id", "url", "html").count() == 0


# ---------------------------------------------------------------- archives


ROWS = [
    (5, "http://x/é 1", "päge"),
    (2, "http://x/2\r\nEvil: 1", "päge"),
    (9, None, "päge"),
    (3, "u", ""),
    (4, "u", None),
    (None, "u", "päge"),
    (None, "v", "only nulls"),
    (7, "u", "z" * 700_000 + "end"),
    (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
]


def test_round_trip_stores_equal_payloads_once(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, PAGES)
    path = f"file://{tmp_path}/w"
    warc.register(spark)
    warc.archive_records(pages, "page_id", "url", "html").write.format("warc").mode("append").save(path)
    out = {(warc_id(r.record_id), r.target_uri): r for r in warc.read_warc(spark, path, verify=True).collect()}
    assert len(out) == len(ROWS)
    first = {"päge": 2, "": 3}
    for page_id, url, page in ROWS:
        r, data = out[page_id, url], (page or "").encode()
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r.payload_bytes == len(data)
        home = first.get(page or "", page_id)
        assert r.record_type == ("response" if home == page_id else "revisit")
        assert r.payload == (bytearray(data) if home == page_id else None)
        assert r.refers_to == (None if home == page_id else f"{warc.ID_PREFIX}{home}")
        assert r.headers["WARC-Type"] == r.record_type


def warc_id(record_id):
    digits = record_id.removeprefix(warc.ID_PREFIX)
    return int(digits) if digits else None


@pytest.mark.parametrize("uri", ["http://h/a%20b", "http://h/a%20b%2Fc", "http://h/100%", "http://h/a b", " u ", "a\nb%41", "\x85é\u2028", ""])
def test_addresses_stay_as_they_are(spark, tmp_path, uri):
    pages = spark.createDataFrame([(1, uri, "x"), (2, None, "y")], PAGES)
    path = f"file://{tmp_path}/w"
    warc.register(spark)
    warc.archive_records(pages, "page_id", "url", "html").write.format("warc").mode("append").save(path)
    out = warc.read_warc(spark, path)
    assert [r.target_uri for r in out.where(out.target_uri == uri).collect()] == [uri]
    held = {r.target_uri: r.headers for r in out.collect()}[uri]
    if "%" in uri and "\n" not in uri:
        assert held["WARC-Target-URI"] == uri


def test_addresses_of_other_archives_are_not_decoded(spark, tmp_path):
    head = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nWARC-Target-URI: http://h/a%20b%2Fc\r\nContent-Length: 2\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(f"{head}hi\r\n\r\n".encode())
    warc.register(spark)
    out = warc.read_warc(spark, str(tmp_path), "record_id string, target_uri string")
    assert out.where("target_uri = 'http://h/a%20b%2Fc'").count() == 1


def test_repeated_smallest_ids_are_responses_each(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "c", "x")], PAGES)
    out = warc.archived(pages, "page_id", "url", "html").collect()
    assert sorted((r.record_id[-1], r.record_type) for r in out) == [("1", "response"), ("1", "response"), ("2", "revisit")]


def test_smaller_payloads_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", "xyz"), (4, "b", "xyz")], PAGES)
    kinds = warc.archive_records(pages, "page_id", "url", "html", least_bytes=2).select("record_id", "record_type").collect()
    assert [k for _, k in sorted(map(tuple, kinds))] == ["response", "response", "response", "revisit"]


def test_predicates_are_pushed_down_and_unwanted_payloads_not_unpacked(spark, tmp_path, monkeypatch):
    rows = [
        {"record_id": f"urn:x:{i}", "record_type": "response", "target_uri": f"http://h/{i}", "date": "d",
         "payload_digest": "D", "refers_to": None, "payload": b"q" * 10**5, "payload_bytes": 10**5}
        for i in range(5)
    ]
    data = b"".join(warc.member(warc.record_bytes(r), 1) for r in rows)
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "_staging-1").mkdir()
    (tmp_path / "_staging-1" / "b.warc.gz").write_bytes(data)
    df = warc.read_warc(spark, str(tmp_path), "record_id string, target_uri string")
    plan = df.where("target_uri = 'http://h/3'")._jdf.queryExecution().executedPlan().toString()
    # only the check for null is left to Spark
    assert "= http" not in plan
    assert [r.record_id for r in df.where("target_uri = 'http://h/3'").collect()] == ["urn:x:3"]
    assert df.where("target_uri like 'http://h/%' and record_id in ('urn:x:1', 'urn:x:9')").count() == 1
    assert df.where("target_uri is null").count() == 0 and df.count() == 5
    reader = warc.WarcReader(df.schema, {"path": str(tmp_path)})
    monkeypatch.setattr(warc.Record, "block", lambda *a: pytest.fail("a payload was unpacked"))
    assert sum(len(b) for p in reader.partitions() for b in reader.read(p)) == 5


def test_plain_files_and_members_without_skip_lengths(spark, tmp_path):
    row = {"record_id": "urn:x:1", "record_type": "response", "target_uri": "http://h/", "date": "d", "payload_digest": None,
           "refers_to": None, "payload": b"body", "payload_bytes": 4}
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x:0>\r\nX-Long: a\r\n b\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + warc.record_bytes(row))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(warc.record_bytes(row)))
    out = warc.read_warc(spark, str(tmp_path)).collect()
    assert sorted((r.record_type, bytes(r.payload)) for r in out) == [("response", b"body")] * 2 + [("warcinfo", b"hello")] * 2
    assert {r.headers.get("X-Long") for r in out if r.record_type == "warcinfo"} == {"a b"}
    assert warc.read_warc(spark, str(tmp_path / "a.warc"), "record_type string").count() == 2


def test_damaged_archives_fail(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response")
    with pytest.raises(Exception, match="cut off"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_base32(spark):
    digests = [hashlib.sha1(bytes([i])).hexdigest() for i in range(20)]
    df = spark.createDataFrame([(d,) for d in digests], "d string")
    for r in df.select("d", warc.base32_of_hex(df["d"]).alias("b")).collect():
        assert r.b == base64.b32encode(bytes.fromhex(r.d)).decode()
