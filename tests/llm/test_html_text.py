"""HTML extraction: marked articles, boilerplate, and the host suffix array against brute force."""

import html
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pulse.llm import html_text, queries

SF = "/root/testdata/sf0.001"


def article_text(page):
    """For pages whose only article is well marked and has no boilerplate inside."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", lambda m: " " if re.match(r"</?(p|br|h1)\b", m[0]) else "", body)).split())


def test_query_gives_the_articles(spark):
    want = {r.page_id: (r.url, article_text(r.html)) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op8_html_text"](spark, SF).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def text(page):
    return " ".join(t for t, article, dropped in html_text.blocks(page) if article and not dropped)


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><h1>A &amp; B</h1><p>x<b>y</b>z<br>w<p>&lt;p&gt; &eacute;&nbsp;&#x41;</article>", "A & B xyz w <p> é A"),
        ("<nav>m</nav><main><header><h1>T</h1></header><div>a</div>b<aside>s</aside><form>f<p>g</form></main>tail", "T a b"),
        ("<article>a<script>var s='</p><p>no';</script><style>p{}</style><!-- c <p> -->b</article>", "ab"),
        ("<article><p>a</p><div class='ad-box'>buy</div><section id=comments><p>hi</section><p>z</article>", "a z"),
        ("<article><div class='advice'>keep</div><div class=\"x cookie-notice\">no</div><p hidden>h</p></article>", "keep"),
        ("<ARTICLE title='a > b'>x\n\n\ty</ARTICLE>", "x y"),
        ("<article>a<p>b</span></b>c</article>d", "a bc"),
        ("<article>open <p>ended", "open ended"),
        ("<article><div role=complementary>r<div>s</div></div>t <script>never ends", "t"),
        ("<main><p style='display: none'>x</p><p>1 < 2 & 3</p></main>", "1 < 2 & 3"),
        ("<article><p class='notice-board'>a</p><div class='search-history'>b</div><section id=related-work>c</section></article>", "a b c"),
        ("<article><div class='comment-list'>x</div><div id='site_footer'>y</div><p class='ad1 big'>z</p><p class='menu-'>m</p>t</article>", "t"),
        ("<article>İİ<script>x</script>b</article>", "İİb"),
        ("", ""),
        (None, ""),
        ("plain", ""),
    ],
)
def test_marks(page, want):
    assert text(page) == want


def brute_repeats(streams, length):
    """{(host, key): places} of prefixes that occur on two keys of a host."""
    seen = defaultdict(set)
    for host, key, words in streams:
        for i in range(len(words) - length + 1):
            seen[host, tuple(words[i : i + length])].add(key)
    out = defaultdict(set)
    for host, key, words in streams:
        for i in range(len(words) - length + 1):
            if len(seen[host, tuple(words[i : i + length])]) > 1:
                out[host, key].add(i)
    return out


@pytest.mark.parametrize("chunk", [30, 10**6])
def test_repeats_match_brute_force_however_a_host_is_cut(spark, monkeypatch, chunk):
    monkeypatch.setattr(html_text, "CHUNK_TOKENS", chunk)
    rng = random.Random(8)
    streams = [(f"h{k % 3}", k, [rng.choice([1, 2, 3]) for _ in range(rng.randrange(0, 25))]) for k in range(40)]
    df = spark.createDataFrame(streams, "host string, key long, stream array<long>")
    got = {(r.host, r.key): set(r.starts) for r in html_text.repeats(df, 4).collect()}
    assert got == brute_repeats(streams, 4)


def test_suffix_ranks_sort_suffixes():
    rng = np.random.default_rng(2)
    s = rng.integers(0, 3, 200)
    for n in (1, 2, 3, 5, 8):
        rank = html_text.suffix_ranks(s, n)
        cut = [tuple(s[i : i + n]) for i in range(len(s))]
        assert all((cut[i] < cut[j]) == (rank[i] < rank[j]) for i in range(0, 200, 7) for j in range(200))


def test_unmarked_pages_lose_repeats_and_keep_unique_runs(spark):
    top = "<div>home news sport weather about us contact</div>"
    foot = "<p>all rights reserved by the example company of somewhere</p>"
    pages = [(k, "http://a.org/x", f"{top}<p>story number {k} tells what w{k} x{k} y{k}</p>{foot}", 1) for k in range(1, 6)]
    pages += [(6, "http://b.org/", f"{top}<p>other</p>", 1), (7, None, "<p>no host</p>", 1), (8, None, None, 1), (9, "http://a.org/", "", 1)]
    pages += [(5, "http://a.org/x", pages[4][2], 1), (None, "http://c.org/", f"<article>{top}</article>", 1), (10, "http://c.org/", f"<article>{top}</article>", 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host int")
    got = [(r.page_id, r.text) for r in html_text.extract(df).collect()]
    menu = "home news sport weather about us contact"
    want = [(k, " ".join(f"story number {k} tells what w{k} x{k} y{k}".split())) for k in (1, 2, 3, 4, 5, 5)]
    want += [(6, f"{menu} other"), (7, "no host"), (8, ""), (9, ""), (None, menu), (10, menu)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def test_unmarked_pages_of_a_large_host_keep_phrases_and_equal_bodies(spark):
    rng = random.Random(6)
    phrases = [" ".join(f"c{k}{j}" for j in range(6)) for k in range(10)]
    menu = "<div>home news sport weather about us contact</div>"
    body = {k: f"a{k} b{k} {rng.choice(phrases)} d{k} {rng.choice(phrases)} e{k}" for k in range(200)}
    body[7] = body[8] = "one article that two pages of the host carry word for word"
    pages = [(k, "http://a.org/", f"{menu}<p>{t}</p>", 1) for k, t in body.items()]
    equal = "the only article of a host that has no other text at all"
    pages += [(k, "http://b.org/", f"<p>{equal}</p>", 1) for k in range(200, 204)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host int")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got == body | {k: equal for k in range(200, 204)}


def test_a_quotation_that_many_pages_have_stays_in_its_sentence(spark):
    quote = " ".join(f"q{k}" for k in range(40))
    pages = [(k, "http://a.org/", f"<p>intro {k} quotes {quote} and goes on with text {k}</p>") for k in range(30)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {k: f"intro {k} quotes {quote} and goes on with text {k}" for k in range(30)}


def test_very_long_pages_take_time_in_proportion():
    import time

    start = time.time()
    n = 100_000
    assert text("<article>" + "<b>" * n + "x" + "</i>" * n + "</b>" * n + "y</article>") == "xy"
    assert text("<article>" + "<div><b></div>" * n + "z") == "z"
    assert text("<article>" + "<script>a</script>" * n + "z") == "z"
    assert time.time() - start < 20


def test_unmarked_corpus_precision_and_recall(spark):
    """No marks at all: menus, notices and footers of a host are shared in parts, bodies have common phrases."""
    rng = random.Random(3)
    phrases = [" ".join(f"c{k}{j}" for j in range(8)) for k in range(15)]
    pages, want = [], {}
    for k in range(240):
        host = "big.org" if k < 160 else f"h{k % 4}.org"
        menu = " ".join(f"{host}m{j}" for j in range(10))
        notices = [" ".join(f"{host}n{v}{j}" for j in range(12)) for v in range(3)]  # a third of the pages each
        body = [" ".join([*(f"w{rng.randrange(3000)}" for _ in range(25)), rng.choice(phrases), f"u{k}"]) for _ in range(6)]
        if k % 10 == 0:
            body = [f"short body {k}"]
        want[k] = " ".join(body).split()
        marked_up = f"<div>{menu}</div><div>{notices[k % 3]}</div>" + "".join(f"<p>{b}</p>" for b in body) + f"<div>{menu[::-1]} end of page</div>"
        pages.append((k, f"http://{host}/{k}", f"<html><body>{marked_up}</body></html>"))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text.split() for r in html_text.extract(df).collect()}
    right = sum(sum((Counter(got[k]) & Counter(want[k])).values()) for k in want)
    assert right / sum(map(len, got.values())) >= 0.95 and right / sum(map(len, want.values())) >= 0.95
