import base64
import gzip
import hashlib
import html
import itertools
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs

from quillsieve.llm.html_text import extracted, main_text, minimum_cut, op4_html_extraction
from quillsieve.llm.warc import op10_warc, payload_figures, read_warc, write_warc
from quillsieve.session import new_folder

PAGES = "page_id int, url string, html string, text string, file string, sha string, first_id int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "t", "f", "s", 0) for r in rows], PAGES)


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(rows, least=0):
    first = {}
    for page_id, _, text in rows:
        body = (text or "").encode()
        if page_id is not None and len(body) >= least:
            first[body] = min(first.get(body, page_id), page_id)
    out = []
    for page_id, _, text in rows:
        body = (text or "").encode()
        to = first.get(body)
        revisit = to is not None and to != page_id
        out.append((page_id, len(body), sha(body), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


ROWS = [(5, "u", "a"), (2, "v\r\nX: y", "a"), (3, None, None), (4, "", ""), (None, "y", "a"), (None, "z", "alone"), (6, "w", "b" * 300_000), (7, "w", "b" * 300_000), (7, "w", "b" * 300_000), (8, "é", "<p>é\r\n\r\n")]


def figures(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_archives_of_awkward_rows(spark):
    for least in (0, 2):
        folder = new_folder(spark, "warc")
        index = write_warc(pages(spark, ROWS).repartition(3), folder, least_bytes=least)
        records = read_warc(index, folder)
        assert figures(payload_figures(records)) == brute(ROWS, least)
        bodies = {r.page_id: bytes(r.payload) for r in records.where("payload is not null and page_id is not null").collect()}
        assert all(bodies[i] == (t or "").encode() for i, _, t in ROWS if i in bodies)


def test_one_record_by_its_range_and_a_selection(spark):
    folder = new_folder(spark, "warc")
    index = write_warc(pages(spark, ROWS), folder)
    row = index.where("page_id = 8").first()
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{path}/{row.file}") as source:
        text = gzip.decompress(source.read_at(row.length, row.offset))
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response") and "<p>é\r\n\r\n".encode() in text
    assert [r.page_id for r in read_warc(index.where("url = 'w'"), folder).orderBy("page_id").collect()] == [6, 7, 7]


def test_no_pages_no_archive(spark):
    folder = new_folder(spark, "warc")
    index = write_warc(pages(spark, []), folder)
    assert index.count() == 0 and read_warc(index, folder).count() == 0


def test_warc_query(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert figures(op10_warc(spark, sf_dir)) == brute(rows)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 6).flatmap(lambda n: st.tuples(*[st.lists(st.integers(0, 9), min_size=n, max_size=n)] * 2, st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(0, 5)), max_size=9))))
def test_cut_is_minimal(case):
    kept, dropped, edges = case
    ties = [{} for _ in kept]
    for i, j, w in edges:
        if i != j:
            ties[i][j] = ties[i].get(j, 0) + w
            ties[j][i] = ties[j].get(i, 0) + w

    def cost(labels):
        own = sum(dropped[i] if keep else kept[i] for i, keep in enumerate(labels))
        return own + sum(w for i in range(len(kept)) for j, w in before[i].items() if i < j and labels[i] != labels[j])

    before = [dict(t) for t in ties]
    got = cost(minimum_cut([float(x) for x in kept], [float(x) for x in dropped], ties))
    assert abs(got - min(map(cost, itertools.product([True, False], repeat=len(kept))))) < 1e-6


def test_parts_of_a_page():
    page = """<html><head><title>T</title><script>var a = "</p>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><div id="cookie-notice">We use cookies. This notice is long, it has sentences. It says more and more, and goes on for a while.</div>
    <nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="sidebar"><p>Popular. Read this as well, it is long enough to look like a paragraph of the article.</p></div>
    <main><article><h1>Head &amp; line</h1><p>First   <b>para</b>graph <a href=x>link</a>&nbsp;end.<p>Second &eacute;&#x41;&copy 2 &lt; 3</p><!-- <p>gone</p> -->
    <ul><li>one<li>two</ul><aside>side</aside><form>Name <input></form><div class="comments"><p>Nice article! I liked it. Thanks a lot for writing all of this down for us.</p></div></article></main>
    <footer>&copy; 2020</footer></body></html><scr"""
    assert main_text(page) == "Head & line\nFirst paragraph link end.\nSecond éA© 2 < 3\none\ntwo"


def test_pages_without_an_article():
    long = "This page has no article element at all. It goes on for some sentences, as articles do. "
    page = f"<div><p>{long}</p><p>Short.</p><p>{long}</p></div><div><a href=1>one</a> <a href=2>two</a></div>"
    assert main_text(page) == f"{long.strip()}\nShort.\n{long.strip()}"


def test_named_main_text_and_attributes_that_only_look_like_marks():
    long = "This is a box that stands beside the text. It has sentences too, and they are as long as those of the text are. "
    page = f"<h1>Head</h1><div class='post-content' data-id='ad' data-hidden='x'><p>Text.</p><p>More text.</p></div><div class='box'><p>{long}</p></div>"
    assert main_text(page) == "Head\nText.\nMore text."
    assert main_text("<article><p>a<p hidden>b<p aria-hidden='false'>c<p style='display: none'>d<div id=comments>e</div></article>") == "a\nc"


def test_awkward_pages(spark):
    deep = "<div>" * 3000 + "<article>deep</article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", "plain words"), (3, "u", deep), (4, "u", "<a \"" * 500), (5, "u", "<script>x"), (6, "u", "<article>" + "<p>ab " * 5000)]
    got = {(r.page_id, r.text) for r in extracted(pages(spark, rows)).collect()}
    assert {(1, ""), (2, ""), (3, "deep"), (4, ""), (5, ""), (6, "\n".join(["ab"] * 5000))} <= got
    assert extracted(pages(spark, rows)).columns == pages(spark, []).columns
    assert extracted(pages(spark, [])).count() == 0


def test_extraction_query_against_the_articles(spark, sf_dir):
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        lines = (" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article))
        want[r.page_id] = (r.url, text := "\n".join(x for x in lines if x), len(text))
    assert {r.page_id: tuple(r)[1:] for r in op4_html_extraction(spark, sf_dir).collect()} == want


def test_marked_inline_elements_end_at_their_end_tag():
    assert main_text('<article><h1>T</h1><span class="share">Share</span><p>body</p><p>more</p></article>') == "T\nbody\nmore"
    assert main_text('<article><p>a <a class="ad">x</a> b</p><p>c</p></article>') == "a\nb\nc"
    assert main_text('<article><p>a <span hidden>x <span>y</span> z</span> b <span>c</span></p></article>') == "a\nb c"
    assert main_text("<article><p>a <b hidden>x</p><p>b</b> c</p><p>d</p></article>") == "a\nb c\nd"


LONG = "This is a paragraph of the page itself. It goes on for some sentences, as the text of articles does. "


def test_values_of_other_attributes_are_not_marks():
    for attribute in ('href="/hidden-markov-model"', 'title="A hidden gem"', 'href="/x.php?id=share"', 'href=/x.php?id=share', 'alt="a class=ad b"'):
        assert main_text(f"<article><p>a <a {attribute}>x</a> b</p></article>") == "a x b", attribute
        assert main_text(f"<article><div {attribute}><p>a</p></div></article>") == "a", attribute


def test_names_and_forms_are_weighed_by_what_they_hold():
    text = f"{LONG.strip()}\nShort.\n{LONG.strip()}"
    body = f"<p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    for start, end in (
        ('<main class="content with-sidebar">', "</main>"),
        ('<article class="post tag-privacy">', "</article>"),
        ('<div class="content with-sidebar">', "</div>"),
        ('<div class="with-sidebar"><article>', "</article></div>"),
        ('<form action="/x.aspx">', "</form>"),
        ('<form><div class="tag-privacy">', "</div></form>"),
        ('<div class="with-sidebar">', "</div>"),
        ('<div role="form" class="page">', "</div>"),
    ):
        assert main_text(f'<body>{start}{body}{end}<div class="ad">Buy this.</div></body>') == text, start
    beside = '<div class="post-comments"><p>Nice article! I liked it a lot. Thanks for writing all of this down for us readers, really.</p></div>'
    login = "<form>Name <input> Password <input></form>"
    assert main_text(f"<article>{body}{beside}{login}</article>") == text
    assert main_text(f"<div>{body}</div>{beside}{login}") == text
    assert main_text(f'<article>{body}<div class="comments"><article class="comment">{LONG}</article></div></article>') == text
