import hashlib
from collections import Counter

import numpy as np
import pytest

from panelspark.llm import html_text, warc
from panelspark.llm.queries import QUERIES
from tests.llm.conftest import SF

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nX-Page-Key: 99\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
BODY = "<p>" + "same words again " * 10 + "</p>"
PAGES = [
    (1, "http://a/1", BODY), (2, None, BODY), (3, "http://a/3\r\nX: y", "small"), (4, "http://a/4", "small"), (5, "u", None),
    (6, "u", ""), (7, "u", FAKE * 20), (8, "u", "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n" * 3), (9, "é", "é" * 50_000),
    (None, "u", BODY), (1, "http://a/1", BODY), (10, "u", FAKE * 20 + BODY), (11, "u", "\r\n\r\nWARC/1.1\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "z", 1) for p in PAGES], "page_id long, url string, html string, `key` string, first int")


@pytest.mark.parametrize("stretch", [64, 1000, 16 << 20])
def test_archives_round_trip(spark, pages, monkeypatch, stretch):
    monkeypatch.setattr(warc, "STRETCH", stretch)
    manifest = warc.write_archives(pages.coalesce(2))
    got = warc.read_archives(spark, manifest, "bigint").collect()
    assert len(got) == len(PAGES)
    want = Counter()
    for key, _, body in PAGES:
        payload = (body or "").encode()
        copies = [k for k, _, b in PAGES if (b or "").encode() == payload and k is not None]
        revisit = len(payload) >= 100 and key != min(copies)
        digest = hashlib.sha256(payload).hexdigest()
        want[key, len(payload), digest, "revisit" if revisit else "response", min(copies) if revisit else None] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    assert {r.url for r in got if r.page_id == 3} == {"http://a/3%0D%0AX:%20y"}


def test_no_pages_make_no_archive(spark, pages):
    manifest = warc.write_archives(pages.limit(0))
    assert manifest.count() == 0 and warc.read_archives(spark, manifest, "bigint").count() == 0


def text_of(page):
    blocks = html_text.blocks_of(page)
    return html_text.main_text(blocks, np.zeros(10_000, bool))


@pytest.mark.parametrize("page, text", [
    ("<nav>menu</nav><article><h1>T</h1><p>a &amp; b<br>c<p>d  <b>e</b>\n f</article><footer>x", "T\na & b c\nd e f"),
    ("<div class='page-with-sidebar'><main><p>x</p><aside>s</aside><form>f</form></main></div>", "x"),
    ("<article><p>x</p><section class=comments><article>no</article></section><div class='ad'>buy</div></article>", "x"),
    ("<article><script>var a='</p>'</script><style>p{}</style><!-- </article> --><p>y</article>", "y"),
    ("<body><p>only <i>open</i> text<header>h</header></body>", "only open text"),
    ("<p don't>x</p> 1 < 2 <a title='>'>l</a>", "x\n1 < 2 l"),
    ("<main><table><tr><td>a</td><td>b</td></tr></table><ul><li>c<li>d</ul></main>", "a\nb\nc\nd"),
    ("<article><p hidden>h</p><p>v &lt;b&gt;&nbsp;&eacute;&#233;</p></article>", "v <b> éé"),
    ("", ""), ("plain", "plain"), ("<!-- open", ""), ("<", "<"),
])
def test_main_text(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("page, text", [
    ("<svg width='1'/><article><p>x</p><svg class=\"a=b\"/><p>y</p></article><svg></svg>", "x\ny"),
    ("<article><p>a <svg><title/><text>no</text><style/></svg> b</p><math/><p>c</p></article>", "a b\nc"),
    ("<article><svg><path d='m'><p>x</p><span>y</span></article>", "x\ny"),
    ("<article><svg><foreignObject><p>no</p></foreignObject></svg><p>x</p></article>", "x"),
    ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> holds</p></article>", "so x=1 holds"),
    ("<article><div><select><option>1<option>2</div><p>x</p></article><select><option>3</select>", "x"),
    ("<article><p>a<select><option>1<p>x</article>", "a\nx"),
    ("<article><select><option>1</select><p>x</p></article>", "x"),
    ("<article><p>a <noscript>no</p><p>x</p></article>", "a\nx"),
    ("<div><template><b>no</div><article><p>x</p></article>", "x"),
    ("<article><template><template>no</template><p>no</p></template><p>x</p></article>", "x"),
    ("<article><noscript><div>no</div></noscript><p>x <textarea></article></textarea> y</p></article>", "x y"),
    ("<article><div><iframe src='a'></div><p>x</p></article>", "x"),
])
def test_elements_without_text(page, text):
    assert text_of(page) == text


def test_hostile_raw_elements_end():
    for tag in ("svg", "math", "select", "noscript", "template", "textarea", "iframe", "title", "script"):
        for page in (f"<{tag}>" * 30_000, f"<p><{tag}>" * 30_000, f"<{tag}><div>" * 20_000, f"<{tag}></div></{tag}>" * 20_000):
            html_text.blocks_of(page)
    html_text.blocks_of("<svg><foreignObject>" + "<div>" * 30_000)


@pytest.mark.parametrize("page, text", [
    ("<body><form><nav>m</nav><div>d</div><article><p>x</p><form>f</form></article></form>", "x"),
    ("<body class='single comments-open'><nav>m</nav><article><p>x</p></article>", "x"),
    ("<body><article class='post has-comments'><p>x</p></article>", "x"),
    ("<html id=comments><main id=respond>x</main><p>o</p>", "x"),
    ("<div class=comments><main><p>x</p></main></div>", "x"),
    ("<div>m</div><div class=comments><article><h1>T</h1><p>x</p></article></div>", "m\nT\nx"),
    ("<article><header class=entry-header><h1>T</h1></header><p>x</p></article><header>h</header>", "T\nx"),
    ("<html><head><title>t</title><body><article>x</article>", "x"),
    ("<html><head><title>t<body><p>x", "x"),
    ("<body><form><nav>m</nav><h1>T</h1><p>x</p></form><form>f</form>", "T\nx"),
    ("<header><article>x</article>", "x"),
    ("<article>x</article><aside><article>teaser</article></aside>", "x"),
    ("<article>x</article><ol class=comment-list><li><article>no</article></ol><article class='comment even'>no</article>", "x"),
    ("<p>x</p><section class=comments><article>no</article></section><form>f</form>", "x"),
    ("<div hidden><article>no</article><main>no</main></div><p>x", "x"),
])
def test_articles_in_furniture(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("page, text", [
    ("<article><p>x</p><section class='social-policy'><p>y</p></section><div class=share-price><p>z</p></div></article>", "x\ny\nz"),
    ("<article><div id='related-work'><h2>Related work</h2><p>see <a href='#1'>one</a> and more</p></div></article>",
     "Related work\nsee one and more"),
    ("<article><p>x</p><div class='promo-story'><h3>More</h3><ul><li><a href=a>one long title</a><li><a href=b>two</a></ul></div></article>", "x"),
    ("<article><p>x</p><div class='share-buttons'><p>y</p></div><div class='ad-slot-2'>y</div><div class=notice>y</div></article>", "x"),
    ("<article><div class='banner-year'><p>x</p><nav>m</nav><div class='ad'>y</div><div class='social-life'>z</div></div></article>", "x\nz"),
    ("<article><p>x</p></article><article class=teaser><a href=a><h3>Title</h3><p>lead</p></a></article>", "x"),
    ("<article class=card><a href=a>only this</a></article><nav>m</nav>", "only this"),
    ("<main><p>x</p><article class='post teaser'><p>a text of its own</p></article></main>", "x\na text of its own"),
    ("<article><a name=top><div class='social-policy'><p>y</p></div></article>", "y"),
])
def test_names_in_doubt(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_elements_in_doubt_go_where_a_host_repeats_them(spark, monkeypatch, limit):
    monkeypatch.setattr(html_text, "BROADCAST_PREFIXES", limit)
    again = "<div class='newsletter-offer'><h3>Offer</h3><p>write to us today and get all of our many fine letters</p></div>"

    def page(i, extra):
        own = " ".join(f"w{i}{w}" for w in "abcdefghijklmnopqrst")
        shared = "these ten words of the story stand on every page"  # in the article itself: they stay
        return f"<article><p>{own}</p><p>{shared}</p>{extra}</article>", f"{own}\n{shared}"

    rows, want = [], {}
    for i in range(4):
        html, text = page(i, again)
        rows.append((i, "http://h/", html))
        want[i] = text
    for i, host in ((10, "h"), (11, "g")):  # unlike the others, and a host with one page
        extra = again if host == "g" else "<div class='newsletter-history'><p>" + " ".join(f"n{w}" for w in "abcdefghijkl") + "</p></div>"
        html, text = page(i, extra)
        rows.append((i, f"http://{host}/", html))
        want[i] = text + ("\nOffer\nwrite to us today and get all of our many fine letters" if host == "g" else "\n" + " ".join(f"n{w}" for w in "abcdefghijkl"))
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_hostile_pages_end():
    for page in ("<" * 100_000, '<a "' * 50_000, "<p x='" * 50_000, '<a x=">"' * 50_000, "<p " + "a" * 300_000 + ">",
                 "<div>" * 30_000 + "</b>" * 30_000, "<script>" + "</script" * 50_000):
        html_text.blocks_of(page)


def test_suffix_array_groups_equal_brute_force():
    rnd = np.random.default_rng(4)
    streams = [[str(t) for t in rnd.integers(0, 3, rnd.integers(0, 40))] for _ in range(12)]
    for depth in (1, 3, 8):
        order, group, owner = html_text.suffix_prefixes(streams, depth)
        flat = [t for s in streams for t in s]
        seen = [tuple(flat[i:i + depth]) for i in order]
        want = Counter(tuple(s[i:i + depth]) for s in streams for i in range(len(s) - depth + 1))
        assert Counter(seen) == want and len(set(group)) == len(want)
        assert all((a == b) == (x == y) for a, b, x, y in zip(seen, seen[1:], group, group[1:]))


MENU = "<div>Home About us and all of our many fine shops in town today</div>"


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_boilerplate_of_a_host_goes(spark, monkeypatch, limit):
    monkeypatch.setattr(html_text, "BROADCAST_PREFIXES", limit)
    rows = [
        (1, "http://h/1", MENU + "<p>first page has its own words</p>"), (2, "http://H:80/2", MENU + "<p>second is not like it</p>"),
        (3, "http://g/3", MENU + "<p>elsewhere</p>"), (4, "http://c/1", MENU), (5, "http://c/2", MENU), (6, None, None), (6, None, None),
        (7, "http://h/7", MENU + "<article><p>story</p></article>"),
    ]
    got = html_text.extract(spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, text int"))
    assert got.columns[:3] == ["page_id", "url", "text"]
    told = {r.page_id: r for r in got.collect()}
    menu = MENU[5:-6]
    assert told[1].text == "first page has its own words" and told[2].text == "second is not like it"
    assert told[3].text == menu + "\nelsewhere" and told[4].text == menu  # one page, and a whole copy
    assert told[6].text == "" and told[7].text == "story" and told[7].n_covered == 13
    assert got.count() == len(rows)
    assert html_text.extract(got.select("page_id", "url", got.text.alias("html")).limit(0)).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_copies_are_no_boilerplate(spark, monkeypatch, limit):
    monkeypatch.setattr(html_text, "BROADCAST_PREFIXES", limit)

    def page(name, changed=None):
        story = [" ".join(f"{name}{i}{w}" for w in "abcdefghijklmnopqrst") for i in range(10)]
        if changed is not None:
            story[changed] = " ".join(f"{name}-new{changed}{w}" for w in "abcdefghijklmnopqrst")
        return MENU + "".join(f"<p>{p}</p>" for p in story), "\n".join(story)

    menu = MENU[5:-6]
    near = {i: page("near", i) for i in range(5)}
    equal = {10 + i: page("equal") for i in range(4)}
    other = {20: page("other"), 21: page("another")}
    rows = [(k, "http://h/", p) for k, (p, _) in {**near, **equal, **other}.items()]
    rows += [(30 + k, "http://g/", p) for k, (p, _) in near.items()]  # nothing but copies: the menu cannot be told
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, (_, story) in {**near, **equal, **other}.items():
        assert got[k] == story, k
    for k, (_, story) in near.items():
        assert got[30 + k] == menu + "\n" + story
    assert len(got) == len(rows)


def test_text_query_keeps_whole_articles(spark):
    import re

    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    import html

    for r in QUERIES["op5_html_text"](spark, SF).collect():
        article = re.search("<article>(.*?)</article>", rows[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(p).split()) for p in re.split("<[^>]*>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)
