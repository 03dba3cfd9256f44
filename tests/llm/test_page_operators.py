"""WARC and HTML operators: round trips and plain versions."""

import base64
import gzip
import hashlib
import html
import io
import re

import pytest

from ebbtide.functions.staging import new_path
from ebbtide.llm import html_wrapper, warc


@pytest.fixture(scope="module")
def captured(spark):
    rows = [
        (1, "http://a.org/x?y#z", "<p>same</p>"), (2, "http://b.org", "<p>same</p>"), (3, None, "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (4, "https://a.org/q", None),
        (5, "bad\r\nurl", ""), (6, "http://a.org/", "x" * 300_000), (7, "http://a.org/s", "<p>same</p>"), (7, "http://a.org/s", "<p>same</p>"), (None, "http://c.org", "lone"),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def test_captures_come_back(captured):
    got = warc.captures(captured).collect()
    assert len(got) == 9
    for r in got:
        source = {1: "<p>same</p>", 2: "<p>same</p>", 3: "<p>é\r\n\r\nWARC/1.1\r\n</p>", 4: "", 5: "", 6: "x" * 300_000, 7: "<p>same</p>", None: "lone"}[r.page_id].encode()
        assert r.payload_bytes == len(source)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(source).digest()).decode()
        assert r.request.http_head.startswith("GET /") and len(r.metadata) == 1
    kinds = sorted(((r.page_id or 0), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([(0, "response", None), (1, "revisit", 7), (2, "revisit", 7), (3, "response", None), (4, "revisit", 5), (5, "response", None),
                            (6, "response", None), (7, "response", None), (7, "revisit", 7)], key=lambda k: (k[0], k[1]))


def test_small_payloads_are_not_revisited_and_payloads_round_trip(spark, captured):
    path = new_path(spark, "warc")
    warc.write_captures(captured, path, min_bytes=12)
    records = warc.read_records(spark, path)
    assert records.where("type = 'revisit'").count() == 0
    payloads = {bytes(r.payload) for r in records.where("type = 'response'").collect()}
    assert "<p>é\r\n\r\nWARC/1.1\r\n</p>".encode() in payloads and b"" in payloads
    assert warc.assemble(records).count() == 9


def test_parse_walks_by_length():
    block = b"HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n"
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(record) + gzip.compress(record))))
    assert [b for _, b in warc.parse(stream)] == [block, block]


def test_empty_pages(captured):
    assert warc.captures(captured.limit(0)).count() == 0
    assert html_wrapper.extract(captured.limit(0)).count() == 0


def test_streams_align_into_optional_and_repeated_groups():
    a = html_wrapper.stream(list(html_wrapper.events("<div><h1>t</h1><p>a<p>b</div>")))
    b = html_wrapper.stream(list(html_wrapper.events("<div><h1>t</h1><ul><li>x</ul><p>c</div>")))
    merged = html_wrapper.align(a, b)
    inner = merged[0][2]
    assert [(i[0], i[1]) for i in inner] == [("h1", "1"), ("ul", "?"), ("p", "+")]
    assert html_wrapper.align(merged, a) == merged == html_wrapper.align(b, merged)


def test_extraction_of_pages(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html_wrapper.extract(real).collect()}
    for r in real.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        pieces = [" ".join(html.unescape(re.sub("<[^>]+>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article.replace("<br>", " "))]
        assert got[r.page_id].text == "\n".join(p for p in pieces if p)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_extraction_without_article_tag_and_of_broken_pages(spark):
    page = "<body><div class='nav'>menu</div><div><div id=top>Site name</div><div><h2>T{0}</h2><p>{1}<form>f</form><script>'<p>no'</script></div></div><div class='comments'>c{0}</div>"
    rows = [(k, "http://h.org/", page.format(k, f"text {k} " * 20), "x") for k in range(4)]
    rows += [(10, None, None, "x"), (11, "nohost", "", "x"), (12, "http://z.org", "<p>open <b>bold &lt;&nbsp;x", "x"), (13, "http://z.org", "<script>never closed", "x"), (None, "http://q.org", "plain", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html_wrapper.extract(frame).collect()}
    assert got[1] == "T1\n" + " ".join(["text 1"] * 20)
    assert (got[10], got[11], got[12], got[13], got[None]) == ("", "", "open bold < x", "", "plain")


def texts_of(spark, pages):
    """Texts of pages given as (url, html), in their order."""
    frame = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_wrapper.extract(frame).collect()}
    return [got[k] for k in range(len(pages))]


def test_modifier_words_in_classes_mark_nothing(spark):
    body = "<h1>Title {0}</h1><p>" + "words of page {0} " * 5
    hosts = {
        "a": "<body class='no-sidebar has-comments'><div>%s</div>", "b": "<body><article class='post has-comments'>%s</article>",
        "c": "<body><main id=search-results>%s</main>", "d": "<body><div class='social-studies'>%s</div>", "e": "<html class=no-banner><body class=menu>%s",
        # The host's text outweighs the mark.
        "f": "<body><div class=widget>%s</div><p>by {0}",
    }
    pages = [(f"http://{h}.org/{k}", (page % body).format(k)) for h, page in hosts.items() for k in range(4)]
    for (url, _), text in zip(pages, texts_of(spark, pages)):
        k = url[-1]
        assert text.startswith(f"Title {k}\n" + " ".join([f"words of page {k}"] * 5)), url


def test_marked_words_and_listed_compounds_still_mark():
    keys = {"nav": "div!", "main-nav": "div!", "comment-list": "div!", "ad": "div!", "site_footer": "div!", "x comments": "div!", "no-sidebar": "div", "has-comments": "div"}
    assert {c: html_wrapper.key_of("div", f" class='{c}'") for c in keys} == keys
    assert [html_wrapper.key_of(t, " class='comment'") for t in ("article", "main", "body", "section")] == ["article!", "main", "body", "section!"]


@pytest.mark.parametrize("odd", [
    "<svg width='1'/>", "<math/>", "<object data=x>", "<audio>", "<video src=y>", "<canvas>", "<button>", "<audio-player src=z></audio-player>", "<video-embed>",
    "<button-group>", "<svg><text>no</text></svg>", "<object><p>no</p><object>no</object></object>", "<button>no <b>no</b></button>", "<script>no</script >",
])
def test_odd_elements_do_not_cut_the_rest(odd):
    page = f"<article><div><p>one</p>{odd}</div><p>two <math><mi>x</mi></math> three</p><video>no</video></article>"
    assert [t for _, t in html_wrapper.blocks(page)] == ["one", "two x three"]


def test_no_part_of_an_unnamed_article_is_dropped(spark):
    lists = "<body><h1>Head {0}</h1><p>Para {0}</p><ul><li>" + "long item {0} " * 20 + "</ul><blockquote><p>quote {0}</blockquote></body>"
    prose = "<body><h1>Head {0}</h1><p>" + "para {0} " * 20 + "</p><ul><li>short {0}</ul></body>"
    named = "<body><p>aside {0}</p><main><p>lead {0}</p></main>"
    nested = "<body><article><p>outer {0}</p><article><p>inner {0}</p></article></article>"
    pages = [("http://h.org/", page.format(k)) for k in range(6) for page in (lists, prose, named, nested)]
    got = texts_of(spark, pages)
    for k in range(6):
        item, para = (" ".join([f"{w} {k}"] * 20) for w in ("long item", "para"))
        assert got[4 * k : 4 * k + 4] == [f"Head {k}\nPara {k}\n{item}\nquote {k}", f"Head {k}\n{para}\nshort {k}", f"lead {k}", f"outer {k}\ninner {k}"]


def test_template_texts_are_found_by_their_slot_in_the_wrapper(spark):
    page = "<body><div>Home | News</div><div>article {0}</div><h2>More</h2><div>Home | News {0}</div>"
    alike = "<body><div>the same page</div>"
    got = texts_of(spark, [("http://h.org/", page.format(k)) for k in range(4)] + [("http://copies.org/", alike)] * 4)
    assert got == [f"article {k}\nHome | News {k}" for k in range(4)] + ["the same page"] * 4


def test_matching_places_every_page_of_the_host():
    pages = ["<h1>t</h1><p>a<p>b", "<h1>t</h1><ul><li>x</ul><p>c", "<p>d<ul><li>y<li>z</ul><p>e", "<p>d"]
    tokens = [list(html_wrapper.events(f"<div>{p}</div>")) for p in pages]
    wrapper = []
    for t in tokens:
        wrapper = html_wrapper.align(wrapper, html_wrapper.stream(t)) if wrapper else html_wrapper.stream(t)
    for t in tokens:
        places = html_wrapper.placed(html_wrapper.skeleton(t), wrapper)
        assert [html_wrapper.path_of(p) for p in places] == [p for p, _ in html_wrapper._texts(t)] and not any("-1:" in p for p in places)
    # A single required item is taken before an optional one of the same kind.
    assert html_wrapper.matched(["p"], [["p", "?", []], ["ul", "?", []], ["p", "1", []]]) == [2]
    assert html_wrapper.matched(["x", "p"], [["p", "1", []]]) == [-1, 0]


def test_pages_nested_deeply(spark):
    levels = 5000
    deep = "<div>" * levels + "<p>one {0}</p>" + "</div>" * levels
    quoted = "<blockquote>" * levels + "two {0}"
    got = texts_of(spark, [("http://deep.org/", page.format(k)) for k in range(2) for page in (deep, quoted, f"<p>lead {{0}}</p>{deep}")])
    assert got == [t.format(k) for k in range(2) for t in ("one {0}", "two {0}", "lead {0}\none {0}")]
    wrapper = html_wrapper.stream(list(html_wrapper.events(f"<h1>t</h1>{deep}<ul><li>a<li><b>b</b><p>c</ul>")))
    text = html_wrapper.written(wrapper)
    assert html_wrapper.written(html_wrapper._read_wrapper(text)) == text and text.count("div") == levels


def test_forms_around_the_article_are_layout(spark):
    article = "<body><form id=x><nav>menu</nav><article><p>text {0}</p><form><label>Name</label><p>send it</p></form></article></form>"
    prose = "<body><form class=page><h1>head {0}</h1><p>" + "word {0} " * 30 + "</p><select><option>pick</select></form>"
    search = "<body><form><p>search</p></form><p>" + "para {0} " * 30 + "</p>"
    for host, page, want in (("a", article, "text {0}"), ("b", prose, "head {0}\n" + " ".join(["word {0}"] * 30)), ("c", search, " ".join(["para {0}"] * 30))):
        assert texts_of(spark, [(f"http://{host}.org/", page.format(k)) for k in range(3)]) == [want.format(k) for k in range(3)]
