"""WARC, HTML, SentencePiece, decontamination and the pipeline."""

import hashlib
import html
import math
import random
import re
import time
import zlib

import pytest

from strandline.llm import decontaminate, html_wrapper, sentencepiece_scan, warc

SF = "/root/testdata/sf0.001"


def test_warc_round_trip(spark):
    big = "<p>é" + "x" * 1200
    rows = [(1, "http://a/1", big), (5, "http://b", big), (3, None, big), (7, "u", "short"), (8, "u", "short"), (9, "u\r\nX: y", None), (10, "u", ""), (None, "n", big)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string").repartition(3)
    got = {r.page_id: r for r in warc.write_and_read(df).collect()}
    assert len(got) == len(rows)
    for i, _, h in rows:
        p = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(p), hashlib.sha1(p).hexdigest())
    assert {i: got[i].refers_to for i in got if got[i].record_type == "revisit"} == {1: 5, 3: 5, None: 5}


def test_warc_filters_skip_payloads(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame([(i, f"http://h{i % 3}/", "y" * 5000 + str(i // 2)) for i in range(40)], "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.records(pages).write.format("warc").mode("append").option("path", path).save()
    back = spark.read.format("warc").load(path)
    revisits = back.where("record_type = 'revisit' and target_uri = 'http://h0/'")
    assert revisits.count() == pages.where("page_id % 2 = 0 and page_id % 3 = 0").count()
    # taken over by the source: no filter on what it took is left in the plan, and one that it can't take is
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan warc" in plan(revisits) and "Filter (" not in plan(revisits)
    left = plan(back.where("record_type = 'revisit' and payload_bytes > 5000")).split("Filter (")[1].split("\n")[0]
    assert "payload_bytes" in left and "record_type" not in left
    full = back.where("record_type = 'response'").select("payload").first().payload
    assert bytes(full).startswith(b"yyyy")
    assert spark.read.format("warc").option("payload", "none").load(path).where("payload is not null").count() == 0


class Counted:
    """zlib's inflater, counting what it gives."""

    total = 0

    def __init__(self, *args):
        self.z = real_inflater(*args)

    def decompress(self, *args):
        out = self.z.decompress(*args)
        Counted.total += len(out)
        return out

    def __getattr__(self, name):
        return getattr(self.z, name)


real_inflater = zlib.decompressobj


def test_warc_inflates_no_unwanted_payload(spark, tmp_path, monkeypatch):
    """Of 50 records of 100 kB, those that a header predicate or option "none" leaves out are inflated by a kilobyte or two at most."""
    from pyspark.sql.datasource import EqualTo, In, StringStartsWith

    rng = random.Random(1)
    pages = spark.createDataFrame([(i, f"http://h{i}/", "".join(rng.choice("abcdefgh") for _ in range(100_000))) for i in range(50)], "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.register(spark)
    warc.records(pages.coalesce(2)).write.format("warc").mode("append").option("path", path).save()
    monkeypatch.setattr(warc.zlib, "decompressobj", Counted)

    def read(filters, **options):
        r = warc.WarcReader({"path": path, **options})
        left = list(r.pushFilters(filters))
        Counted.total = 0
        rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
        return left, rows, Counted.total

    left, rows, inflated = read([EqualTo(("target_uri",), "http://h7/")])
    assert not left and [x["record_id"] for x in rows] == ["urn:strandline:page:7"] and inflated < 100_000 + 50 * 3000
    assert read([In(("record_type",), ("revisit",))])[1:] == ([], pytest.approx(0, abs=50 * 3000))
    left, rows, inflated = read([StringStartsWith(("target_uri",), "http://h1"), EqualTo(("payload_bytes",), 5)], payload="none")
    assert len(left) == 1 and len(rows) == 11 and all(x["payload"] is None for x in rows) and inflated < 50 * 3000
    assert read([])[2] > 50 * 100_000


def test_warc_of_repeated_rows_long_payloads_and_clashing_columns(spark):
    long = "z" * 5_000_000
    rows = [(2, "u", long, "a", "b")] * 2 + [(1, "v", long, "a", "b"), (3, None, "short", "a", "b"), (3, None, "short", "a", "b")]
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.write_and_read(spark.createDataFrame(rows, "page_id long, url string, html string, payload string, first string")).collect())
    assert got == [(1, 5_000_000, "revisit", 2), (2, 5_000_000, "response", None), (2, 5_000_000, "response", None), (3, 5, "response", None), (3, 5, "response", None)]


def test_places_of_paths(tmp_path):
    assert warc.place("/a/b")[1] == "/a/b" and warc.place("file:/a/b")[1] == "/a/b" and warc.place("file:///a/b")[1] == "/a/b"
    where, path = warc.place("s3a://bucket/a?region=us-east-1")
    assert where.type_name == "s3" and path == "bucket/a"


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as Some

    from strandline.llm.common import shared_dir

    conf = Some(get=lambda *a: None, set=lambda *a: None)
    session = lambda master: Some(conf=conf, sparkContext=Some(master=master, getConf=lambda: conf))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("local[2]"))


def test_warc_reads_foreign_members(tmp_path):
    import gzip

    data = b"".join(gzip.compress(warc.record(f"urn:x:{i}", "response", "http://a", None, "d", 3, b"abc")) for i in range(3))
    (tmp_path / "a.warc.gz").write_bytes(data)
    r = warc.WarcReader({"path": str(tmp_path), "payload": "full"})
    rows = [x for p in r.partitions() for b in r.read(p) for x in b.to_pylist()]
    assert [x["record_id"] for x in rows] == ["urn:x:0", "urn:x:1", "urn:x:2"] and all(x["payload"] == b"abc" for x in rows)


def test_warc_empty(spark):
    assert warc.write_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


PAGE = "<html><head><title>t</title></head><body><header>Site</header><nav><ul><li><a>x</a></li></ul></nav><div class='cookie-notice'>We use</div><main><article><header><h1>T &amp; U</h1></header>{body}<div class=\"comments\"><p>no</p></div><aside>n</aside></article></main><form>q<input></form><footer>z</footer></body></html>"


def host_pages(template, n=6, seed=1, paragraphs=(3, 6)):
    """Pages of one host with unlike articles, and their blocks: template has {title}, {body} and {k}."""
    rng = random.Random(seed)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    out = []
    for k in range(n):
        blocks = [words(5), *(words(rng.randint(20, 40)) for _ in range(rng.randint(*paragraphs)))]
        out.append((template.format(title=blocks[0], body="".join(f"<p>{b}</p>" for b in blocks[1:]), k=words(2)), blocks))
    return out


def wrapper_of(pages):
    return html_wrapper.Wrapper.loads(html_wrapper.infer(html_wrapper.unlike([p for p, _ in pages])).dumps())


@pytest.mark.parametrize("body, want", [
    ("<p>a <i>b</i>\n c<p>d", "a b c\n\nd"), ("<ul><li>e<li>f</ul>", "e\n\nf"), ("<table><tr><td>1<td>2</table>", "1\n\n2"), ("<p>x<script>var a='</p>';</script>y</p>", "xy"), ("<p>1<br>2</p>", "1 2"), ("<p>&lt;b&gt; &eacute; &#65;</p>", "<b> é A"), ("<p></p><!-- c --><div class=ad>buy</div>", ""),
    ("<p class='notice-period'>n</p><h2 id=search>s</h2>", "n\n\ns"), ("<a href='x>y'>l</a> <p title=\"a'b\">q", "l\n\nq"), ("<b>1<div>2</b>3</div>4", "1\n\n23\n\n4"), ("<p>z<!-- never closed", "z"),
])
def test_main_text_by_names(body, want):
    assert html_wrapper.main_text(PAGE.format(body=body)) == "T & U" + ("\n\n" + want if want else "")


def test_wrapper_finds_slots_options_and_repetitions():
    w = html_wrapper.infer(["<div><h1>a</h1><ul><li>1</li><li>2</li></ul></div>", "<div><h1>b</h1><b>new</b><ul><li>1</li><li>2</li><li>3</li><li>4</li></ul></div>"]).nodes
    assert html_wrapper.SLOT in w
    assert any(isinstance(x, tuple) and x[0] == "+" and x[1][0] == "<li>" for x in w)
    assert any(isinstance(x, tuple) and x[0] == "?" and x[1][0] == "<b>" for x in w)


BARE = "<html><body><div><div>Home</div><div>Products and services</div></div><div><div>{k}</div></div><div><h1>{title}</h1><div>Filed under news, all rights reserved</div>{body}<div>Tell your friends about this page</div></div><div><div>Made in a hurry</div></div></body></html>"


def test_only_the_wrapper_reads_pages_without_telling_names():
    """Template text, in and around an article whose elements have no names to go by, is known by staying the same; and the article by
    holding nearly all that varies."""
    pages = host_pages(BARE, 9)
    w = wrapper_of(pages[:6])
    for page, blocks in pages:
        assert html_wrapper.main_text(page, w) == "\n\n".join(blocks)
        plain = html_wrapper.main_text(page)
        assert "Filed under" in plain and "Products" in plain and "Made in" in plain
    # of what no sample page had, content stays, and known names go
    page = pages[6][0].replace("<p>", "<ul><li>new item</li></ul><div class='comments'><p>no</p></div><p>", 1)
    assert html_wrapper.main_text(page, w).split("\n\n")[:2] == [pages[6][1][0], "new item"] and "no" not in html_wrapper.main_text(page, w).split("\n\n")


def test_wrapper_decides_on_template_text_in_articles():
    pages = host_pages("<body><nav>{k}</nav><article><h1>{title}</h1><div>Print this article</div>{body}<p>By <b>{k}</b></p></article></body>")
    w = wrapper_of(pages)
    for page, blocks in pages:
        got = html_wrapper.main_text(page, w).split("\n\n")
        assert got[:-1] == blocks and got[-1].startswith("By ") and "Print this article" in html_wrapper.main_text(page)


def test_fixed_headings_within_an_article_stay():
    """A heading that all articles of a host have is theirs; site text around it, and a heading that nothing follows, go."""
    pages = host_pages("<body><nav>{k}</nav><article><h3>Welcome to the site</h3><h1>{title}</h1><div>Print this article</div>{body}<h2>Conclusion</h2><p>So {k}</p><table><tr><th>Source</th><td>{k}</td></tr></table><h4>Share this</h4><div>All rights reserved</div></article></body>")
    w = wrapper_of(pages)
    for page, blocks in pages:
        got = html_wrapper.main_text(page, w).split("\n\n")
        assert got[: len(blocks) + 1] == [*blocks, "Conclusion"] and got[len(blocks) + 1].startswith("So ") and got[len(blocks) + 2] == "Source" and len(got) == len(blocks) + 4


def test_wrapper_decides_on_ambiguous_names():
    """A class that is boilerplate elsewhere holds the article here, and the other way round."""
    pages = host_pages("<body><article><h1>{title}</h1><div class='discussion'>{body}</div><div class='related'><a href=x>{k}</a></div><div class=notice>We use things</div></article></body>")
    w = wrapper_of(pages)
    for page, blocks in pages:
        assert html_wrapper.main_text(page, w) == "\n\n".join(blocks)
        assert html_wrapper.main_text(page) == blocks[0]


def test_copies_are_no_template():
    """A host of one article in many copies, with another number on each page, keeps its text."""
    one = host_pages("<body><article><h1>{title}</h1>{body}</article></body>", 1)[0]
    copies = [(f"<!-- {k} -->" + one[0].replace("</h1>", f"</h1><p>no {k}</p>"), one[1]) for k in range(10)]
    assert len(html_wrapper.unlike([p for p, _ in copies])) == 1
    w = html_wrapper.infer([p for p, _ in copies[:2]])
    assert not w.template and html_wrapper.main_text(copies[5][0], w).split("\n\n") == [one[1][0], "no 5", *one[1][1:]]


def test_wrapper_aligns_whole_pages():
    """What lies thousands of tokens down a page is aligned too."""
    pages = host_pages(BARE, 5, paragraphs=(600, 900))
    w = wrapper_of(pages)
    assert all(html_wrapper.main_text(p, w) == "\n\n".join(b) for p, b in pages)


def test_html_in_linear_time():
    began = time.time()
    for page in ("<a " * 300_000, "<a '" * 100_001 + ">", "<!" * 300_000, "<? " * 300_000, "<" * 500_000, "<div>" * 100_000 + "</i>" * 100_000, "<b><div>" * 60_000 + "</b>" * 60_000, "<div>x" * 60_000, "<p class=" * 100_000 + ">", "<script " * 100_000, "&amp" * 200_000):
        html_wrapper.main_text(page)
        list(html_wrapper.tally(html_wrapper.tokens(page), set()))
    w = wrapper_of(host_pages(BARE, 5))
    html_wrapper.main_text("<div><em>x</em>" * 60_000, w)
    assert time.time() - began < 60


def test_pages_of_the_tables(spark):
    got = {r.page_id: r for r in html_wrapper.op6_html_wrapper(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        a = re.sub(r"</?b>", "", re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1].replace("<br>", " "))
        want = "\n\n".join(y for y in (" ".join(html.unescape(z).split()) for z in re.split(r"</?(?:p|h1)>", a)) if y)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want))


def test_html_edges(spark):
    rows = [(1, None, None), (2, "http://h/", ""), (3, "bad url", "plain text"), (None, "http://h/", "<p>a</p>"), (4, "http://h/", "<article><p>never closed"), (5, "http://h/", "<<<>><p>")]
    got = {r.page_id: r.text for r in html_wrapper.extract(spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, host string")).collect()}
    assert got[1] == "" and got[2] == "" and got[3] == "plain text" and got[None] == "a" and got[4] == "never closed"
    assert html_wrapper.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_of_hosts(spark):
    """Wrappers by host, over repeated rows and many copies of one page, with columns named as the operator's own."""
    pages = host_pages(BARE, 8)
    rows = [(i, "http://A.example/x", p, "h", "w") for i, (p, _) in enumerate(pages)] + [(100 + i, "https://a.example:80/y", pages[0][0], "h", "w") for i in range(40)] + [(3, "http://a.example/x", pages[3][0], "h", "w"), (200, "http://other/", pages[0][0], "h", "w")]
    got = html_wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string, wrapper string").repartition(5)).collect()
    assert len(got) == len(rows)
    want = {i: "\n\n".join(b) for i, (_, b) in enumerate(pages)}
    assert all(r.text == want.get(r.page_id, want[0]) for r in got if r.page_id != 200)
    assert "Made in a hurry" in next(r.text for r in got if r.page_id == 200)


def html_texts(spark, pages):
    return {r.page_id: r.text.split("\n\n") for r in html_wrapper.extract(spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(3)).collect()}


def test_all_pages_of_a_host_count(spark):
    """The ten pages of least hash, which any sample by hash would begin with, are unlike the other fifty: a text that they share is no
    template, one that they lack is, and an element that only others have holds those articles' texts."""
    page = "<body><nav>{{k}}</nav><article><h1>{{title}}</h1><div>{fixed}</div>{{body}}{more}</article></body>"
    few, most, odd = (host_pages(page.format(fixed=fixed, more=more), 150) for fixed, more in (("Filed under old news", ""), ("Print this article", ""), ("Print this article", "<div class='discussion'><p>So {k}</p></div>")))
    rows = [(i, v, x[i][0]) for v, x in enumerate((few, most, odd)) for i in range(150)]
    h = {(r.i, r.v): r.h for r in spark.createDataFrame(rows, "i int, v int, html string").selectExpr("i", "v", "xxhash64(html) h").collect()}
    first = sorted(range(150), key=lambda i: h[i, 0])[:10]
    rest = [i for i in range(150) if i not in first and min(h[i, 1], h[i, 2]) > h[first[-1], 0]][:50]
    assert len(rest) == 50
    late = sorted(rest, key=lambda i: h[i, 2])[-10:]
    some = [(x[i], x is odd) for x, of in ((few, first), (most, [i for i in rest if i not in late]), (odd, late)) for i in of]
    got = html_texts(spark, [p for (p, _), _ in some])
    for k, ((_, blocks), more) in enumerate(some):
        want = [blocks[0], "Filed under old news", *blocks[1:]] if k < 10 else blocks
        assert got[k][: len(want)] == want and len(got[k]) == len(want) + more and (not more or got[k][-1].startswith("So "))


def test_many_near_copies_are_no_template(spark):
    """Of 48 pages, 40 are one article with another number: its text stays, and what the others have in common with it goes."""
    pages = host_pages("<body><article><h1>{title}</h1><div>Print this article</div>{body}</article></body>", 9)
    near = [pages[0][0].replace("</article>", f"<p>no {k}</p></article>") for k in range(40)]
    got = html_texts(spark, [*near, *(p for p, _ in pages[1:])])
    assert all(got[k] == [*pages[0][1], f"no {k}"] for k in range(40))
    assert all(got[40 + k] == blocks for k, (_, blocks) in enumerate(pages[1:]))
    # with nothing else on the host, all is the article's
    assert html_texts(spark, near)[7] == [pages[0][1][0], "Print this article", *pages[0][1][1:], "no 7"]


def test_hosts_are_counted_as_few_pages_are(spark):
    """The wrapper that Spark's counts give is that of the same pages in one process."""
    layouts = {
        "bare": BARE,
        "named": "<body><nav>{k}</nav><main><h1>{title}</h1><article><div>Print this article</div>{body}</article></main></body>",
        "ambiguous": "<body><article><h1>{title}</h1><div class='discussion'>{body}</div><div class='related'><a href=x>{k}</a></div><div class=notice>We use \"things\" é</div></article></body>",
        "both": "<body class='sidebar'><div class='notice x'><div><h1>{title}</h1>{body}</div></div><form>{k}</form><div class='alert'>Now</div></body>",
    }
    pages = {name: [p for p, _ in host_pages(x, seed=k)] for k, (name, x) in enumerate(layouts.items())}
    df = spark.createDataFrame([(f"http://{name}/", p) for name, x in pages.items() for p in x], "url string, html string").repartition(3)
    by_hash = [r.html for r in df.selectExpr("html", "xxhash64(html) h").orderBy("h").collect()]
    got = {r.host: r.wrapper for r in html_wrapper.wrappers(df, html_wrapper.Scratch(spark)).collect()}
    assert got.keys() == pages.keys()
    for name, x in pages.items():
        want = html_wrapper.infer([p for p in by_hash if p in x])
        assert html_wrapper.Wrapper.loads(got[name]).dumps() == want.dumps() and want.template


@pytest.fixture(scope="module")
def model():
    pytest.importorskip("sentencepiece")
    return sentencepiece_scan.library(sentencepiece_scan.MODEL)


def test_scan_equals_library(spark, model, monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abc  nthe\n▁éé漢😀") for _ in range(400)) for _ in range(12)] + ["thering" * 90, "a" * 300, " " * 300, "", None, "x y" * 200, "x y" * 200]
    monkeypatch.setattr(sentencepiece_scan, "CHUNK", 40)
    # workers take the module's own value, so the pieces are cut and joined here
    import pandas as pd

    lat = sentencepiece_scan.lattice(sentencepiece_scan.MODEL)
    for t in filter(None, texts):
        p = pd.concat(sentencepiece_scan._cut([pd.DataFrame({"doc_id": [1], "h": ["h"], "text": [t]})]), ignore_index=True)
        m = [sentencepiece_scan.transfer(lat, *x) for x in zip(p.part, p.a, p.b)]
        s = sentencepiece_scan.path(m, "0:", "end")
        ids = [i for x in zip(p.part, p.a, p.b, s, s[1:]) for i in sentencepiece_scan.backtrace(lat, model, *x)]
        assert ids == model.encode(t), t
        # however they are put in brackets, the product is one, and its path the same
        whole = sentencepiece_scan.product(m)
        assert ("0:", "end") in whole
        for k in range(1, len(m)):
            halves = [sentencepiece_scan.product(m[:k]), sentencepiece_scan.product(m[k:])]
            assert sentencepiece_scan.product(halves) == whole and sentencepiece_scan.path(halves, "0:", "end")[1] == s[k]


def test_encode_giant_documents(spark, model):
    rng = random.Random(9)
    giant = " ".join("".join(rng.choice("etaoin") for _ in range(rng.randint(1, 9))) for _ in range(9000))
    rows = [(1, giant), (1, giant), (2, giant[:50]), (3, None), (4, ""), (None, giant[::-1]), (5, "ab" * 20_000)]
    got = sentencepiece_scan.encode(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, ids int")).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    want = {i: model.encode(t or "") for i, t in rows}
    back = {r.doc_id: r.text for r in sentencepiece_scan.decode(sentencepiece_scan.encode(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert all(list(r.ids) == want[r.doc_id] and r.n_tokens == len(r.ids) for r in got)


def test_states_come_down_many_rounds(spark, model, monkeypatch):
    """A segment is one round; two hundred chunks, with two paths of which one reaches the end, take two rounds up and down."""
    import pandas as pd

    from strandline.llm.common import Scratch

    m = sentencepiece_scan
    monkeypatch.setattr(m, "CHUNK", 30)
    lat, rows, want = m.lattice(m.MODEL), [], {}
    for i, t in ((1, "the theory of abc bca thering " * 20), (None, "ab" * 90), (3, "short text of one chunk")):
        p = pd.concat(m._cut([pd.DataFrame({"doc_id": [i], "h": ["h"], "text": [t]})]), ignore_index=True)
        ms = [m.transfer(lat, *x) for x in zip(p.part, p.a, p.b)]
        rows += [(i, "h", k, [f for f, _ in x], [g for _, g in x]) for k, x in enumerate(ms)] * (2 if i == 1 else 1)
        s = m.path(ms, "0:", "end")
        want |= {(i, k): x for k, x in enumerate(zip(s, s[1:]))}
    table = spark.createDataFrame(rows, "doc_id long, h string, no int, from array<string>, to array<string>")
    got = {(r.doc_id, r.no): (r.s0, r.s1) for r in m._states(table, 40, Scratch(spark)).collect()}
    assert got == want
    far = spark.createDataFrame([(1, "h", k, ["a", "b"] if k else ["0:"], (["a", "b"] if k else ["a"]) if k < 199 else ["end", "x"]) for k in range(200)], table.schema)
    assert {(r.no, r.s0, r.s1) for r in m._states(far, 199, Scratch(spark)).collect()} == {(k, "a" if k else "0:", "a" if k < 199 else "end") for k in range(200)}


def test_encode_and_decode_edges(spark, model):
    m, schema = sentencepiece_scan, "doc_id long, text string, h string, n_tokens string"
    assert m.encode(spark.createDataFrame([], schema)).count() == 0
    assert m.decode(spark.createDataFrame([], "doc_id long, ids array<int>")).count() == 0
    texts = ["a  b", " lead", "tab\tand\nline", "漢字 😀 \u0000 é", "x" * 5_000, "", None]
    got = m.encode(spark.createDataFrame([(i, t, "h", "n") for i, t in enumerate(texts)] * 2, schema))
    assert sorted((r.doc_id, r.text) for r in m.decode(got).collect()) == sorted([(i, t or "") for i, t in enumerate(texts)] * 2)
    rows = [(1, None), (None, []), (2, [None, 300])]
    assert {r.doc_id: r.text for r in m.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()} == {1: "", None: "", 2: model.decode([300])}


def test_decontamination_against_all_scores(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 20))) + ". " + " ".join(word() for _ in range(rng.randint(3, 9))) + ".") for i in range(60)] + [(100, None), (101, ""), (102, "!!"), (103, "single")]
    docs = []
    for i in range(120):
        w = [word() for _ in range(rng.randint(0, 200))]
        if i % 3 == 0:
            k = rng.randrange(60)
            at = rng.randint(0, len(w))
            w[at:at] = items[k][1].upper().split() if i % 2 else items[k][1].replace(".", " ,").split()
        docs.append((i, " ".join(w)))
    ix = decontaminate.Index(items[:60])
    for _, text in docs:
        words = [ix.term.get(x, -1) for x in decontaminate.tokens(text)]
        for k in range(0, max(1, len(words)), ix.step):
            terms = sorted({t for t in words[k : k + 2 * ix.step] if t >= 0})
            want = {}
            for t in terms:
                for item, s in ix.postings[t]:
                    want[item] = want.get(item, 0.0) + s
            want = {i for i, s in want.items() if s >= decontaminate.THRESHOLD}
            got = {i for b in range(ix.bound.shape[1]) for i, _ in ix.search(terms, b)}
            assert got == want
    df = spark.createDataFrame([*docs, (500, None), (501, ""), (None, items[3][1])], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    rng = random.Random(10)
    assert {d for d, _ in found if d is not None} >= {i for i in range(120) if i % 3 == 0} and (None, 3) in found
    assert len({d for d, _ in found if d is not None and d % 3}) <= 2
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(df, empty).count() == 0


def test_decontamination_over_any_white_space(spark):
    """Each character that is white space to Python parts words, in items and documents alike."""
    white = [c for c in map(chr, range(0x110000)) if c.isspace()]
    item = "what is the capital of france. the capital is paris indeed"
    rows = [(i, "Well, " + item.replace(" ", c) + " ok") for i, c in enumerate(white)] + [(99, item.replace("of ", "of\u3000\xa0")), (100, item.replace(" ", "\u200b"))]
    for text in (item, item.replace(" ", "\xa0"), item.replace("capital ", "capital\u2003\n")):
        items = spark.createDataFrame([(7, text)], "item_id long, text string")
        found = {r.doc_id for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
        assert found == {*range(len(white)), 99}


@pytest.mark.parametrize("text", ["A b\x1cC\x85d", "\xa0x\u3000Y\u2028z ", "ΣΑΣ. ΑΣ", "plain Text\ttoo", "", "\x1f"])
def test_words_are_those_of_str(text):
    assert [w.decode() for w in decontaminate.words_of(text.encode())] == text.lower().split()


def test_decontamination_does_not_depend_on_slices(spark, monkeypatch):
    """Items of one subject stand together: their words are rare among all items, and common in their slice."""
    rng = random.Random(12)
    items = [(i, " ".join(rng.choice("abcdefgh"[i // 20 :][:3]) + rng.choice("uvwxyz") + rng.choice("klm") for _ in range(rng.randint(8, 30))) + ".") for i in range(60)]
    docs = []
    for i in range(120):
        w = rng.choice(items)[1].split()
        docs.append((i, " ".join(["none"] * rng.randint(0, 9) + w[: rng.randint(len(w) // 2, len(w))] + ["other"] * rng.randint(0, 9))))
    df, test = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in decontaminate.contaminated(df, test).collect()}
    want = found()
    assert len(want) > 30
    for n in (59, 20, 7):
        monkeypatch.setattr(decontaminate, "ITEMS", n)
        got = found()
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def plain_contaminated(docs, items):
    """All items against all passages of all documents, with sets and sums."""
    d = decontaminate
    texts = sorted({(i, t) for i, t in items if t and d.tokens(t)})
    words = {k: d.tokens(t) for k, (_, t) in enumerate(texts)}
    n, mean, step = len(texts), sum(map(len, words.values())) / len(texts), max(map(len, words.values()))
    df = {}
    for w in words.values():
        for x in set(w):
            df[x] = df.get(x, 0) + 1
    impact = lambda k, x: math.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) * words[k].count(x) * (d.K1 + 1) / (words[k].count(x) + d.K1 * (1 - d.B + d.B * len(words[k]) / mean))
    out = {}
    for i, t in docs:
        ws = d.tokens(t or "")
        for at in range(0, len(ws), step):
            here = ws[at : at + 2 * step]
            for k, (item, text) in enumerate(texts):
                share = sum(impact(k, x) for x in set(words[k]) & set(here)) / sum(impact(k, x) for x in set(words[k]))
                if share < d.THRESHOLD - 1e-9:
                    continue
                has = {tuple(here[a : a + m]) for m in (1, 2, 3) for a in range(len(here) - m + 1)}
                q, a, w = (len(d.grams(x) & has) / len(d.grams(x)) for x in (*d.parts(text), words[k]))
                if q >= d.OVERLAP and (a >= d.OVERLAP or w >= d.WHOLE):
                    out[i, item] = max(out.get((i, item), (0, 0, 0)), (round(share, 6), round(q, 6), round(a, 6)))
    return out


def test_verified_items_against_plain_sets(spark, monkeypatch):
    """Whole, edited and cut items, repeated and empty documents, very long items, clashing columns; one item an index or all in one."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4)))
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 25))) + "? " + " ".join(word() for _ in range(rng.randint(2, 9))) + ".") for i in range(25)] + [(30, " ".join(word() for _ in range(400)) + "."), (31, None), (32, "É à ü. Ñ")]
    docs = []
    for i in range(80):
        w = rng.choice(items[:26])[1].split()
        w = w[rng.randint(0, len(w) // 3) :] if i % 2 else w
        for _ in range(len(w) // 6 if i % 3 == 0 else 0):
            w[rng.randrange(len(w))] = word()
        docs.append((i, " ".join([word() for _ in range(rng.randint(0, 60))] + w + [word() for _ in range(rng.randint(0, 60))])))
    docs += [(100, None), (101, ""), (102, "x É à ü. ñ, y"), (103, "É à ü. Ñ"), (104, "word " * 200_000 + items[0][1])]
    want = plain_contaminated(docs, items)
    assert len(want) > 40
    schema = "doc_id long, text string, item_id string, score string"
    df = spark.createDataFrame([(*r, "s", "t") for r in docs + docs[:1]], schema)
    test = spark.createDataFrame([(*r, "d") for r in items + items[:2]], "item_id long, text string, doc_id string")
    for n in (4000, 1):
        monkeypatch.setattr(decontaminate, "ITEMS", n)
        rows = decontaminate.contaminated(df, test).collect()
        got = {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in rows}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
        assert len(rows) == len(want) + sum(i == 0 for i, _ in want)
        assert decontaminate.contaminated(spark.createDataFrame([], schema), test).count() == 0


@pytest.fixture()
def stages():
    import corpus_pipeline

    return dict(corpus_pipeline.STAGES)


def folder(spark, tmp_path, labels, items):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_null_empty_and_repeated_documents(spark, tmp_path, stages):
    """Each stage's decision, and what it leaves alone, with columns named as the operators' own."""
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))
    item, key = words(20) + "? " + words(8) + ".", "a1b2c3d4e5f60718293a4b5c6d7e8f9012345678"
    bad = [(i, f"{words(12)} zzinsult {words(3)}") for i in range(100, 160)]
    clean = [(i, words(15)) for i in range(200, 300)]
    one, long = words(60), "word " * 100_000 + words(30)
    odd = [(1, None), (2, ""), (3, "  \n"), (None, None), (None, one), (4, long), (5, one), (6, one + " more"), (5, one), (7, f"{words(30)} {item} {words(30)}"), (8, f'{words(9)} token = "{key}" {words(5)}'), (9, "漢字 é")]
    rows = [(i, t, "e", "s", len(t or "")) for i, t in bad + clean + odd]
    # columns beyond those of the table, named as what the operators add
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], DOCUMENTS + ", component_id string, score string, spans_ string")
    sf = folder(spark, tmp_path, [(i, 0, 1) for i, _ in bad[:45]] + [(i, 1, 0) for i, _ in clean[:80]] + [(None, 1, 1), (5, None, None)], [(1, item), (2, None), (None, "")])
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    all_ = sorted(bad + clean + odd, key=repr)
    kept = stages["toxicity"](spark, docs, sf)
    assert kept.columns == docs.columns and texts(kept) == sorted(clean + odd, key=repr)
    kept = stages["ngram_jaccard"](spark, docs, sf)
    assert texts(kept) == [x for x in all_ if x[0] != 6]
    kept = stages["decontamination"](spark, docs, sf)
    assert texts(kept) == [x for x in all_ if x[0] != 7]
    kept = stages["secrets"](spark, docs, sf)
    assert texts(kept) == sorted(((i, (t or "").replace(key, "[SECRET]") if t is not None else None) for i, t in all_), key=repr)
    assert all(r.n_chars == len(r.text or "") for r in kept.collect()) and kept.columns == docs.columns
    done = stages["sentencepiece"](spark, docs, sf)
    assert sorted((r.doc_id for r in done.collect()), key=repr) == sorted((i for i, _ in all_), key=repr) and done.where("not round_trip").count() == 0


def test_stages_on_empty_tables(spark, tmp_path, stages):
    sf = folder(spark, tmp_path, [], [])
    none, some = spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([(1, "a b c", "e", "s", 5), (2, None, None, None, None)], DOCUMENTS)
    for name, stage in stages.items():
        assert stage(spark, none, sf).count() == 0, name
        assert stage(spark, some, sf).count() == 2, name


def test_stages_against_plain_ones(spark, stages):
    """Near duplicates, decontamination and ids of the tables' own documents by brute force, over whole texts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 2 = 0")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages["decontamination"](spark, docs, SF).collect()}
    assert kept == set(rows) - {i for i, _ in plain_contaminated(list(rows.items()), items)}
    library = sentencepiece_scan.library(sentencepiece_scan.MODEL)
    assert {r.doc_id: list(r.ids) for r in stages["sentencepiece"](spark, docs, SF).collect()} == {i: library.encode(t) for i, t in rows.items()}
    shingles = {}
    for i, t in rows.items():
        w = "".join(c.lower() if c.isascii() else c for c in t).encode().split()
        shingles[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    top = {i: i for i in rows}
    find = lambda i: i if top[i] == i else find(top[i])
    for a in rows:
        for b in rows:
            if a < b and shingles[a] and 5 * len(shingles[a] & shingles[b]) >= 4 * len(shingles[a] | shingles[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    assert {r.doc_id for r in stages["ngram_jaccard"](spark, docs, SF).collect()} == {i for i in rows if find(i) == i}


def test_pipeline(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in c.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, SF)
        assert kept.columns == docs.columns, name
        assert kept.count() <= before.count()
    done = c.run(spark, SF)
    assert done.count() == kept.count() and set(done.columns) == {"doc_id", "n_tokens", "ids", "round_trip"}
    groups = c.near_duplicates(kept).groupBy("component_id").count().where("count > 1").count()
    assert groups == 0
