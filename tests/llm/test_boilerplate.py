import html as H
import re

import pytest

from tessera.llm import boilerplate as B
from tessera.llm.html_blocks import blocks_of


def plain(page):
    """The article of a generated page, by its fixed template."""
    m = re.search(r"<article>(.*)</article>", page, re.S)
    return " ".join(H.unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", m[1]))).split())


def test_generated_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = {r["page_id"]: (r["url"], plain(r["html"])) for r in pages.collect()}
    got = B.main_text(pages).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r["url"], r["text"]) == want[r["page_id"]] and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("page, text", [
    ("<article><h1>A &amp; B</h1><p>one\n two<br>three</p></article>", "A & B one two three"),
    ("<header><h1>Site</h1></header><nav>x</nav><main><p>in</p><aside>y</aside><footer>z</footer></main><p>out", "in"),
    ("<article><p>a<b>b</b>c<p class='ad'>buy<p>d<div class=\"related posts\"><div>n</div>m</div>e</article>", "abc d e"),
    ("<article>a<section id=comments><article class='comment'>c</article></section>b</article>", "a b"),
    ("<article>x<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no --> y &lt;b&gt; &#233;&nbsp;z</article>", "x y <b> é z"),
    ("<div id='cookie-notice'>ok?</div><div role=banner>b</div><p>text 1 < 2</p><form>f</form>", "text 1 < 2"),
    ("<article><p>open <i>never closed", "open never closed"),
    ("<article><ul><li>one<li class=share>s<li>two</ul></article>", "one two"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"), ("", ""), (None, ""), ("<html><body></body></html>", ""), ("<p", "<p"),
    ("<article><table><tr><td>a<td>b</table></article><article>second</article>", "a b second"),
    ('<article><p>The <span class="search">quick</span> fox</p><p class="notice-period">n</p><section class="social-science">s</section>'
     '<div class="header-row">h</div><p>end</p></article>', "The quick fox n s h end"),
    ("<article><p>a <a href='x' class='share'>b</a></p><div class='Share buttons'>no</div><div id=comment-1>c</div></article>", "a b c"),
    ("<p>a <b x='1>2'>c</b> 3 < 4 <5 d", "a c 3 < 4 <5 d"), ("<p>x</p><a title=\"never closed><p>y</p><b>z</b>", "x y z"),
    ("<article>k<!-- open comment <p>no</p>", "k"), ("<p>q</p><b c=\"1", "q <b c=\"1"),
])
def test_structure(spark, page, text):
    blocks = blocks_of(page)
    best = min((p for p, _ in blocks), default=2)
    assert " ".join(t for p, t in blocks if p == best) == text


def brute_cut(streams):
    """Tokens covered by a substring of MIN_RUN tokens that another distinct stream of the host has."""
    out = []
    for i, s in enumerate(streams):
        t = B.stream_of(s)
        cover = set()
        for a in range(len(t) - B.MIN_RUN + 1):
            run = t[a:a + B.MIN_RUN]
            for j, o in enumerate(streams):
                u = B.stream_of(o)
                if o != s and any(u[b:b + B.MIN_RUN] == run for b in range(len(u) - B.MIN_RUN + 1)):
                    cover |= set(range(a, a + B.MIN_RUN))
        out.append(" ".join(x for k, x in enumerate(t) if k not in cover and x != "\n"))
    return out


def test_open_pages_by_the_host(spark):
    menu = ["home", "about us", "all our products", "contact and legal notes"]
    pages, streams = [], []
    for i in range(12):
        own = [f"p{i} begins here", " ".join(f"w{i}x{k}" for k in range(30))]
        blocks = [*menu, *own, "read more of this site on the pages below"]
        streams.append(blocks)
        pages.append((i, "http://A.example/x", "<body>" + "".join(f"<div>{b}</div>" for b in blocks)))
    pages.append((12, "http://b.example/", pages[0][2]))  # another host: nothing is repeated there
    pages.append((13, "http://a.example/copy", pages[0][2]))  # a copy on the host
    pages.append((13, "http://a.example/copy", pages[0][2]))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = B.main_text(df).collect()
    want = brute_cut(streams)
    assert len(got) == 15
    for r in got:
        i = r["page_id"]
        assert r["text"] == (" ".join(streams[0]) if i == 12 else want[0] if i == 13 else want[i])
    assert want[3].startswith("p3 begins here") and want[3].endswith("w3x29")


def test_nulls_empty_and_long(spark):
    long = "<article>" + "<p>word &amp; " * 50_000
    rows = [(None, None, None), (1, None, ""), (1, None, ""), (2, "no address", "<p>a</p>"), (3, "http://h", long)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id long, url string, html string, `a.b` int, host int")
    got = sorted((tuple(r) for r in B.main_text(df).collect()), key=str)
    text = " ".join(["word &"] * 50_000)
    assert got == sorted([(None, None, "", 0), (1, None, "", 0), (1, None, "", 0), (2, "no address", "a", 1),
                          (3, "http://h", text, len(text))], key=str)
    assert B.main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<a ", "<", "<!", "<a \"", "<a 'x", "</", "<a\"<b'", "<!--", "<p class=\"ad\"", "<a<"])
def test_broken_markup_takes_linear_time(piece):
    import time
    start = time.time()
    blocks_of(piece * (1_000_000 // len(piece)))
    assert time.time() - start < 3


def test_near_copies_keep_their_text(spark):
    words = [f"word{k}" for k in range(60)]
    page = lambda blocks: "<body>" + "".join(f"<div>{b}</div>" for b in blocks)
    two = [(1, "http://a.example/1", page([" ".join(words)])), (2, "http://a.example/2", page([" ".join([*words[:30], "extra", *words[30:]])]))]
    menu = "home products about contact legal press jobs help sitemap imprint"
    more = [(10 + i, "http://b.example/x", page([menu, " ".join(f"own{i}x{k}" for k in range(40))])) for i in range(6)]
    copies = [(20, "http://b.example/c", page([menu, " ".join(words)])), (21, "http://b.example/d", page([menu, " ".join([*words, "more"])]))]
    heavy = [(30 + i, "http://c.example/x", page([menu + " " + " ".join(f"m{k}" for k in range(60)), f"own{i}a own{i}b own{i}c"])) for i in range(5)]
    rows = two + more + copies + heavy
    got = {r["page_id"]: r["text"] for r in B.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == " ".join(words) and got[2] == " ".join([*words[:30], "extra", *words[30:]])
    assert got[12] == " ".join(f"own2x{k}" for k in range(40))
    assert got[20] == " ".join(words) and got[21] == " ".join([*words, "more"])
    assert got[33] == "own3a own3b own3c"


def test_blocks_beside_the_article():
    page = "<nav><ul><li>a <b>b</b><li>c</ul></nav><article>x<div class=share>s<p>t</div>y</article><footer>f<br>g</footer><p>o"
    assert blocks_of(page, beside=True) == [(3, "a b"), (3, "c"), (0, "x"), (3, "s"), (3, "t"), (0, "y"), (3, "f g"), (2, "o")]
    assert blocks_of(page) == [(0, "x"), (0, "y"), (2, "o")]


def test_articles_by_the_host(spark):
    """A notice that the host sets beside its articles goes where it stands inside one without a mark; shared passages stay."""
    notice = "we use small files to keep you known here read our rules"
    shared = "a passage of many words that two articles of this host have in common"
    teaser = "the first words of an article that another page shows in its sidebar"
    rows, want = [], {}
    for i in range(8):
        own = " ".join(f"w{i}x{k}" for k in range(20))
        inside = i in (1, 2)
        page = (f"<nav>home about</nav>{'' if inside else f'<div class=notice>{notice}</div>'}<aside>{teaser if i == 3 else ''}</aside><article>"
                f"{f'<div>{notice}</div>' if inside else ''}<p>{own}</p><p>{shared if i < 3 else teaser if i == 4 else ''}</p></article>")
        rows.append((i, "http://a.example/x", page))
        want[i] = own + (" " + shared if i < 3 else " " + teaser if i == 4 else "")
    # quoted within a block, on another host, and as a whole article it stays
    rows += [(10, "http://a.example/q", f"<article><p>it says {notice} and more</p><p>own text of the page</p></article>"),
             (11, "http://b.example/q", f"<article><p>{notice}</p><p>own text of the page</p></article>"),
             (12, "http://a.example/n", f"<article><p>{notice}</p></article>")]
    want |= {10: f"it says {notice} and more own text of the page", 11: f"{notice} own text of the page", 12: notice}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in B.main_text(df).collect()} == want


def test_open_pages_learn_from_pages_with_articles(spark):
    """Runs that pages with an article hold, beside it or in it, count for the open pages of their host."""
    menu = "home products about contact legal press jobs help sitemap imprint"
    passage = "ten plain words that an article has and a page quotes"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(25))
    rows = [(i, "http://a.example/x", f"<nav>{menu}</nav><article><p>{own(i)}</p><p>{passage if i == 2 else ''}</p></article>") for i in range(4)]
    want = {i: own(i) + (" " + passage if i == 2 else "") for i in range(4)}
    # one open page beside them: the menu and the quoted passage occur on other pages
    rows += [(10, "http://a.example/o", f"<body><div>{menu}</div><div>{own(10)}</div><div>{passage}</div>"),
             # a print of an article loses the menu and keeps the text, on its own host only
             (11, "http://a.example/p", f"<body><div>{menu}</div><div>{own(1)}</div><div>printed</div>"),
             (12, "http://b.example/o", f"<body><div>{menu}</div><div>{own(10)}</div>"),
             # what stands beside its own text on one page alone is no repeat
             (13, "http://c.example/o", f"<nav>{menu}</nav><div>{menu}</div><div>{own(13)}</div>")]
    want |= {10: own(10), 11: own(1) + " printed", 12: f"{menu} {own(10)}", 13: f"{menu} {own(13)}"}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in B.main_text(df).collect()} == want
