"""Operators on pages: HTML extraction, URL rules, WARC archives."""

import collections
import hashlib
import html
import random
import re

import pytest
from pyspark.sql import functions as F

from tenura.llm import html_extraction, url_filter, warc
from tenura.llm.storage import shared_folder

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id bigint, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(1, None, None), (2, "", ""), (3, "nonsense", "<p>"), (4, "http://A.b/x", "<article>" + "word " * 50_000),
            (4, "http://A.b/x", "<article>" + "word " * 50_000), (None, "http://a.B?q", "<div>" * 3000 + "deep"),
            (5, "http://a.b/\r\n\tx", "plain < text & <unclosed")]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = ["host", "path", "rule", "row", "text", "tree", "digest", "kind", "value"]
    return df.select("*", *(F.lit("mine").alias(c) for c in extra))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# HTML extraction

def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split())
              for x in re.split("</?(?:p|h1)>", inner))
    return " ".join(b for b in blocks if b)


def test_articles_of_all_pages(pages):
    found = html_extraction.extract(pages)
    assert found.columns == [*pages.columns, "text"]
    rows = found.collect()
    assert len(rows) == pages.count() and all(r["text"] == article(r["html"]) for r in rows)


def read(page):
    tree, slots, *rest = html_extraction.read_page(page)
    names = html_extraction.Aligner().names(tree, None)
    return html_extraction.main_text([names[i] for i in slots], *rest, {})


def test_parts_that_are_not_the_article():
    page = """<!DOCTYPE html><html><head><title>T</title></head><body class="has-sidebar">
      <header class="site-header"><h1>Site</h1></header><div id="menu"><ul><li><a href=x>Home</a></li></ul></div>
      <div class="cookie-notice">We use cookies</div><form><input name=q><button>Go</button>Search it</form>
      <div class="wrapper"><div id="content"><h1>Real &amp; title</h1>
      <p>First  para &lt;b&gt; a &nbsp; b<script>var a="</p><p>x";</script> cont <b>bo</b>ld.</p><div class=ad>Buy</div>
      <ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table><p>a < b and c</p><!-- <p>no</p> -->
      <div class="comments"><h3>Comments</h3><article class="comment"><p>nice</p></article></div></div>
      <aside>Side</aside></div><footer>&copy; 2020</footer></body></html>"""
    assert read(page) == "Real & title First para <b> a b cont bold. one two c1 c2 a < b and c"
    assert read("<div class='has-sidebar'><article>in<aside>out</aside><p>in</div>") == "in in"
    assert read("<article><header><h1>Title</h1><span>by me</span></header><p>x</p><footer>f</footer></article>") == "Title x"
    assert read("<main hidden>a</main><p>b") == "b"
    assert read("<p><a href=x>only a link</a></p><p>text <a href=y>l</a> text</p>") == "text l text"


def test_constant_slots_are_template(spark):
    rows = [(i, f"http://h.example/{i}", f"<div><p>Only on this site, since 1999</p><p>Story {i} {'x' * i}</p><section>The end</section></div>"
             if i % 2 else f"<div><section>New {i}</section><section>The end</section></div>") for i in range(20)]
    rows += [(100 + i, "http://same.example/", "<main><p>always this</p></main>") for i in range(5)]
    rows += [(200, "http://few.example/", "<div><p>one of a kind</p></div>")]
    found = {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[200] == "one of a kind"
    assert found[100] == "always this"  # a named article stays
    assert found[3] == "Only on this site, since 1999 Story 3 xxx The end"  # the slots' texts vary
    assert found[2] == "New 2 The end"
    rows = [(i, "http://t.example", f"<div class=a>Fixed</div><div class=b>Text {i}</div><div class=c>Fixed too</div>") for i in range(9)]
    found = {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i: f"Text {i}" for i in range(9)}


def test_articles_that_repeat_are_not_template(spark):
    end = "<section>Read more here</section>"
    rows = [(i, "http://quotes.example/", f"<article><h1>Day {i}</h1><p>Told on day {i}</p>{end}</article>") for i in range(20)]
    quote = "<article><h1>Copy{0}</h1><p>As they say</p><blockquote>Only here</blockquote>" + end + "</article>"
    rows += [(100 + i, "http://quotes.example/", quote.format("")) for i in range(3)]  # equal pages
    rows += [(200 + i, "http://quotes.example/", quote.format(f" {i}")) for i in range(3)]  # equal but for the headline
    rows += [(300 + i, "http://bodies.example/", f"<article><h1>Headline {i}</h1><p>{'The one body' if i else 'Another'}</p></article>")
             for i in range(5)]
    rows += [(400 + i, "http://plain.example/", f"<div><p>Day {i}</p>{'<blockquote>Only here</blockquote>' if i < 4 else ''}</div>")
             for i in range(20)]
    found = {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[3] == "Day 3 Told on day 3"  # what all articles of the host end with is template
    for i in range(3):
        assert found[100 + i] == "Copy As they say Only here" and found[200 + i] == f"Copy {i} As they say Only here"
    assert [found[300 + i] for i in range(5)] == ["Headline 0 Another", *(f"Headline {i} The one body" for i in range(1, 5))]
    assert found[400] == "Day 0 Only here" and found[410] == "Day 10"


def test_tree_matching():
    tree = html_extraction.from_skeleton
    a, b = tree("r ( a ( x y ) b c )"), tree("r ( b a ( y x ) c d )")
    size, pairs = html_extraction.tree_matching(a, b)
    assert size == 4 and len(pairs) == 4  # r, a, one of x and y, c
    assert html_extraction.tree_matching(a, tree("s"))[0] == 0
    slots, _ = html_extraction.parse("<div><p>a<p>b</div><ul><li>x<li>y</ul>")
    assert html_extraction.skeleton(slots) == "# ( div ( p ) ul ( li ) )"


def test_extraction_of_awkward_pages(awkward, nothing):
    found = html_extraction.extract(awkward)
    assert found.columns == [c for c in awkward.columns if c != "text"] + ["text"]
    rows = sorted((r["page_id"] or 0, len(r["text"])) for r in found.collect())
    assert rows == [(0, 4), (1, 0), (2, 0), (3, 0), (4, 249_999), (4, 249_999), (5, 14)]
    assert html_extraction.extract(nothing).count() == 0


def test_broken_html_never_fails():
    rng = random.Random(7)
    bits = ["<div>", "</div>", "<p>", "<b", ">", "<!--", "-->", "text", "&amp", "<a href='", "'", '"', "<script>", "</script>",
            "<article>", "</article>", "<li>", "<td>", "<![CDATA[", "\x00", "ü", "<br/>", "<svg/>"]
    for _ in range(500):
        page = "".join(rng.choices(bits, k=30))
        tree, slots, *_ = html_extraction.read_page(page)
        assert html_extraction.from_skeleton(tree) is not None and all(i < len(tree.split()) for i in slots)
        read(page)


# URL rules

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("both.net", "/", "allow"), ("both.net", "/", "block"), ("x.y", "", "block")]
URLS = ["http://example.org/es/1", "https://A.Example.ORG/en/12?x", "http://example.org/en/2", "http://example.org", "http://notexample.org/es/",
        "ftp://com/fr/", "http://www.shop.com/de/#a", "http://com.net/fr/", "http://both.net/a", "http://x.y", "http://z.x.y/q?://", None, "",
        "example.org/es/", "://", "http:///es/", "http://example.org:80/es/", "http://ÄÖ.org/x", "a://b://c"]


def judged_by_hand(url, rules, default="allow"):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0].translate(str.maketrans(url_filter.UPPER, url_filter.LOWER))
    path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    fit = [(len(h + p), h + p, v == "block", v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[1], best[3] if best else default


def test_rules_by_hand(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS[:3])], "page_id bigint, url string")
    rules = spark.createDataFrame([*RULES, (None, "/", "allow"), ("a", None, None)], "host string, path string, verdict string")
    rows = url_filter.judge(df, rules).collect()
    assert len(rows) == len(URLS) + 3
    for r in rows:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == judged_by_hand(r["url"], RULES), r["url"]


def test_cascade_is_exact_at_a_high_error_rate(spark):
    """Two bits for a key: every level makes many mistakes, the cascade none."""
    universe = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    universe = universe.union(universe.limit(100)).union(spark.sql("select cast(null as string) as key"))
    listed = spark.range(0, 3000, 7).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    cascade = url_filter.build_cascade(listed, universe, bits_per_key=2, hashes=2)
    assert len(cascade.levels) > 2
    found = universe.dropna().distinct().where(cascade.contains(F.col("key"))).collect()
    assert sorted(r["key"] for r in found) == sorted(f"k{i}" for i in range(0, 3000, 7))
    with pytest.raises(ValueError):
        url_filter.build_cascade(listed, universe, max_filter_bytes=100)
    assert universe.where(url_filter.build_cascade(listed.limit(0), universe).contains(F.col("key"))).count() == 0


def test_rules_and_awkward_pages(spark, awkward, nothing):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = url_filter.judge(awkward, rules)
    assert set(found.columns) == {*awkward.columns, "verdict"} and found.count() == awkward.count()
    assert url_filter.judge(nothing, rules).count() == 0
    assert {r["verdict"] for r in url_filter.judge(awkward, rules.limit(0), default="block").collect()} == {"block"}


# WARC

def expected(rows, least=100):
    """(page_id, bytes, digest, type, refers) of each row."""
    payloads = collections.defaultdict(list)
    for i, _, h in rows:
        payloads[h or ""].append(i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        ids = [x for x in payloads[h or ""] if x is not None]
        first = min(ids) if ids and len(body) >= least and len(payloads[h or ""]) > 1 else None
        again = first is not None and i != first
        out.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def round_trip(spark, df, name, **options):
    path = f"{shared_folder(spark)}/{name}"
    warc.write(df, path, **options)
    return warc.read(spark, path)


def test_archive_round_trip(spark, pages):
    rows = [tuple(r) for r in pages.collect()]
    rows += [(1000 + i, u, h) for i, u, h in rows[:20]] + [(2000, None, None), (2001, "u", ""), (2002, "u", "short"), (2003, "u", "short"),
                                                          (2004, "a\r\nb", "ü" * 60), (None, "u", "ü" * 60)]
    df = spark.createDataFrame(rows, SCHEMA)
    for n, size in enumerate(("128m", "20k")):  # whole files, then ranges that cut records
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = round_trip(spark, df.repartition(3), f"warc-{n}").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        got = [(r["page_id"] and int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
                r["refers_to"] and int(r["refers_to"])) for r in found]
        assert sorted(got, key=repr) == expected(rows)
        by_id = {i: h for i, _, h in rows}
        for r in found:
            if r["record_type"] == "response":
                assert r["payload"].decode() == (by_id[r["page_id"] and int(r["page_id"])] or "")
            else:
                assert r["payload"] is None


def test_false_magic_inside_records():
    """Stored, not packed: the magic stands in the payloads and cuts records at the ends of ranges."""
    records = [b"WARC/1.0\r\n" + bytes([i]) * 50 + b"\x1f\x8b\x08" * (i % 4) + b"tail" for i in range(30)]
    members = [warc._member(r, 0) for r in records]
    whole = b"".join(members)
    for cut in range(1, len(whole), 37):
        parts = []
        # a range has the pieces that start in it: the last of the first range runs to the next magic
        at = [m.start() for m in re.finditer(re.escape(warc.MAGIC), whole)] + [len(whole)]
        chunks = [(a, whole[a + 3:b]) for a, b in zip(at, at[1:])]
        for own in ([c for a, c in chunks if a < cut], [c for a, c in chunks if a >= cut]):
            parts += list(warc._range(own))
        found = [d for k, d in parts if k == "record"]
        cut_parts = [d for k, d in parts if k != "record"]
        assert all(whole for whole, _ in warc._members(cut_parts))
        found += [d for _, d in warc._members(cut_parts)]
        assert sorted(found) == sorted(records), cut


def test_a_magic_that_could_go_on_forever():
    """What follows a false magic can read as a member with a name that never ends."""
    false = warc.MAGIC + b"\x08" + b"\xff" * 40
    records = [b"WARC/1.0\r\n" + (false if i == 2 else b"") + bytes([65 + i]) * 30 for i in range(8)]
    members = [warc._member(r, 0) for r in records]
    chunks = b"".join(members).split(warc.MAGIC)[1:]
    assert len(chunks) == 9
    assert list(warc._range(chunks)) == [("record", r) for r in records]
    late = list(warc._range(chunks[3:]))  # begins with the false one
    assert late[0] == ("tail", false + records[2][10 + len(false):] + members[2][-8:]) and late[1:] == [("record", r) for r in records[3:]]


def test_long_records_get_an_empty_member():
    long = b"WARC/1.0\r\n" + b"x" * (17 << 20)
    member = warc._member(long, 1)
    assert member.endswith(warc.EMPTY_MEMBER) and member[-1] == 0
    body = member[:-len(warc.EMPTY_MEMBER)]
    assert list(warc._range([body[3:], warc.EMPTY_MEMBER[3:]])) == [("record", long)]


def test_archives_of_awkward_pages(spark, awkward, nothing):
    rows = [tuple(r)[:3] for r in awkward.collect()]
    found = round_trip(spark, awkward, "warc-awkward").collect()
    got = [(r["page_id"] and int(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
            r["refers_to"] and int(r["refers_to"])) for r in found]
    assert sorted(got, key=repr) == expected(rows)
    assert round_trip(spark, nothing, "warc-none").count() == 0


# pages that lost their article, or held a task up

def texts_of(spark, pages):
    df = spark.createDataFrame([(i, f"http://h{host}.org/{i}", page) for i, (host, page) in enumerate(pages)],
                               "page_id int, url string, html string")
    return [r["text"] for r in html_extraction.extract(df).orderBy("page_id").collect()]


def test_names_do_not_hide_an_article(spark):
    """Themes name articles after categories; words in other attributes and inside longer names don't count."""
    body = "<h1>Title</h1><p>First words of it.</p>"
    pages = [
        f'<nav>Menu</nav><article class="post-12 post type-post category-social tag-share">{body}</article><footer>End</footer>',
        f'<article>{body}<p title="a hidden gem">Second.</p></article>',
        f'<article>{body}<p title="class=ad" data-x=\'id="comments"\'>Second.</p></article>',
        f'<article>{body}<section class="legal-analysis"><p>Second.</p></section></article>',
        f'<article>{body}<div class="search-results-study"><p>Second.</p></div></article>',
        f'<article>{body}<p>Second.</p><div class="site-notice">Notice</div><p hidden>no</p><p style="display:none">no</p></article>',
        f'<article>{body}<p>Second.</p></article><article class="comment-body"><p>Me too</p></article>',
    ]
    got = texts_of(spark, list(enumerate(pages)))
    assert got == ["Title First words of it."] + ["Title First words of it. Second."] * 6


def test_one_body_under_several_headlines(spark):
    """Four pages of a host with their own headlines and one long body keep the body; the menu goes."""
    prose = " ".join(f"word{i} and more of it" for i in range(30))
    for open_, shut in (("<article>", "</article>"), ("<div>", "</div>")):
        pages = [(1, f"<body><div><a href=/>Home</a> <a href=/b>More</a></div>{open_}<h1>Headline {i}</h1><p>{prose}</p>{shut}</body>")
                 for i in range(4)]
        assert texts_of(spark, pages) == [f"Headline {i} {prose}" for i in range(4)]


def test_the_wrapper_decides_without_an_article(spark):
    """No element says what it is: what all pages of the host say goes, what varies stays, also beside unlike pages."""
    def page(i):
        return (f"<body><div class=a1><p>Welcome to the site of all things</p></div><div class=b2><h2>Number {i}</h2>"
                f"<p>Text of number {i}.</p></div><div class=c3><p>All rights are kept by the owner</p></div></body>")

    pages = [(1, page(i)) for i in range(6)] + [(2, page(9))]
    got = texts_of(spark, pages)
    assert got[:6] == [f"Number {i} Text of number {i}." for i in range(6)]
    assert "Welcome" in got[6] and "rights" in got[6]  # a host of one page has no wrapper


def test_elements_nested_deeply(spark):
    """However deep, a part that isn't the article stays out, and end tags close their own elements."""
    for depth in (150, 250, 500, 3000):
        page = f"<article><p>One.</p>{'<div>' * depth}<nav>Menu</nav><p>Two.</p>{'</div>' * depth}<p>Three.</p></article><p>After</p>"
        assert texts_of(spark, [(1, page)]) == ["One. Two. Three."]


@pytest.mark.parametrize("piece", ['<a x="', "<a x='", "<a ", "<", "</a", "<a x=\"<b y='", "<!--", "<!", "<div>", "<li>", "<p", "</p>", "<b>",
                                   "<i></b>", "<svg/", "<td><li>", "<div></li>", "\"<a '>", "<script>"])
def test_broken_markup_is_read_in_linear_time(piece):
    import time

    begun = time.process_time()
    blocks = html_extraction.read_page("<p>words</p>" + piece * (400_000 // len(piece)))[2]
    assert time.process_time() - begun < 20 and blocks[0] == "words"


def test_long_lists_of_children_match_quickly():
    import time

    a = "body ( " + "p div " * 3000 + ")"
    b = "body ( h1 " + "div p " * 2500 + "p )"
    begun = time.process_time()
    for x, y in ((a, a), (a, b), (b, a)):
        size, pairs = html_extraction.tree_matching(html_extraction.from_skeleton(x), html_extraction.from_skeleton(y))
        assert size == len(pairs) and size > 4000
        assert sorted(pairs) == sorted(pairs, key=lambda p: p[1])
    assert time.process_time() - begun < 20


def test_matching_with_equal_ends_is_the_largest():
    """Against the plain rule without short cuts, on small random trees."""
    import random

    rng = random.Random(3)

    def tree(depth):
        kids = [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []
        return rng.choice("ab") + (f" ( {' '.join(kids)} )" if kids else "")

    def plain(a, b):
        if a.key != b.key:
            return 0
        best = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
        for i, x in enumerate(a.kids, 1):
            for j, y in enumerate(b.kids, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + plain(x, y))
        return best[-1][-1] + 1

    for _ in range(300):
        a, b = (html_extraction.from_skeleton(f"r ( {tree(3)} {tree(2)} )") for _ in range(2))
        size, pairs = html_extraction.tree_matching(a, b)
        assert size == plain(a, b) == len(pairs) == len(dict(pairs))


def _foreign(kind, block, *lines, version="1.1"):
    head = [f"WARC/{version}", f"WARC-Type: {kind}", *lines, f"content-length:{len(block)}"]
    return "\r\n".join(head).encode("latin-1") + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    """Records of all types, chunked bodies, digests as written, continued and Latin-1 headers, names in any case."""
    import gzip
    import hashlib

    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nhello\r\n7;x=y\r\n, world\r\n0\r\n\r\n"
    broken = b"HTTP/1.1 200 OK\r\ntransfer-encoding: chunked\r\n\r\nnot chunked at all"
    records = [
        _foreign("warcinfo", b"software: x\r\n", "WARC-Record-ID: <urn:uuid:0>", version="1.0"),
        _foreign("request", b"GET / HTTP/1.1\r\n\r\n", "WARC-Record-ID: <urn:uuid:1>"),
        _foreign("response", chunked, "WARC-Record-ID: <urn:uuid:2>", "WARC-Target-URI: http://a.org/\xe9"),
        _foreign("response", broken, "warc-record-id:<urn:uuid:3>", "WARC-Target-URI:", " http://a.org/", "\tlong"),
        _foreign("revisit", b"HTTP/1.1 200 OK\r\nContent-Length: x\r\n\r\n", "WARC-Record-ID: <urn:uuid:4>",
                 "WARC-Refers-To: <urn:uuid:2>", "WARC-Payload-Digest: sha1:ABCDEF"),
        _foreign("revisit", b"", "WARC-Record-ID: <urn:uuid:5>"),
        _foreign("resource", b"\x00\xff data", "WARC-Record-ID: <urn:uuid:6>"),
        _foreign("metadata", b"", "no colon here", "WARC-Record-ID: <urn:uuid:7>"),
        b"WARC/1.0\r\nWARC-Type: conversion\r\n\r\nno length\r\n\r\n",
    ]
    (tmp_path / "crawl.warc.members").write_bytes(b"".join(gzip.compress(r) for r in records))
    rows = {r["record_id"]: r for r in warc.read(spark, str(tmp_path)).collect()}
    assert len(rows) == len(records)
    got = {(k or "-")[-1]: (r["record_type"], None if r["payload"] is None else bytes(r["payload"]), r["url"]) for k, r in rows.items()}
    assert got == {
        "0": ("warcinfo", b"software: x\r\n", None), "1": ("request", b"GET / HTTP/1.1\r\n\r\n", None),
        "2": ("response", b"hello, world", "http://a.org/\xe9"), "3": ("response", b"not chunked at all", "http://a.org/ long"),
        "4": ("revisit", None, None), "5": ("revisit", None, None), "6": ("resource", b"\x00\xff data", None),
        "7": ("metadata", b"", None), "-": ("conversion", b"no length", None)}
    again, bare = rows["urn:uuid:4"], rows["urn:uuid:5"]
    assert (again["payload_digest"], again["refers_to_id"], again["refers_to"], again["payload_bytes"]) == ("sha1:ABCDEF", "urn:uuid:2", None, None)
    assert (bare["payload_digest"], bare["payload_bytes"], bare["page_id"]) == (None, None, None)
    assert rows["urn:uuid:2"]["payload_digest"] == hashlib.sha256(b"hello, world").hexdigest()
