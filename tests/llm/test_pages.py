"""Operators on pages."""

import random
import time

import numpy as np
import pytest

from brevetlake.llm import html_main, url_filter

URLS = [
    ("https://News.Example.com/en/12?x=1", "news.example.com", "/en/12", "com/en/", "block"),
    ("http://a.example.com/en/77/#top", "a.example.com", "/en/77/", "example.com/en/7", "allow"),
    ("http://example.com/en/7", "example.com", "/en/7", "example.com/en/7", "allow"),
    ("http://m.example.net/de/8x", "m.example.net", "/de/8x", "example.net/de/8", "block"),
    ("http://net/de/", "net", "/de/", "net/de/", "block"),
    ("http://internet/de/", "internet", "/de/", None, "allow"),
    ("http://x.org/es/1", "x.org", "/es/1", "org/es/", "block"),
    ("http://x.org/ES/1", "x.org", "/ES/1", None, "allow"),
    ("http://garden.org?q=/es/", "garden.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("https://www.casino-jackpot.info/x", "www.casino-jackpot.info", "/x", None, "block"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"),
    ("x\ny://H\no/p\nq?r", "h\no", "/p\nq", None, "allow"),
    ("https://", "", "", None, "allow"),
    ("http://É.org/es/", "É.org", "/es/", "org/es/", "block"),
    ("http://example.org/" + "long/" * 20_000, "example.org", "/" + "long/" * 20_000, None, "allow"),
]


def test_url_filter(spark):
    rows = [(k, u, "h") for k, (u, *_) in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = {r.page_id: r for r in url_filter.judge(pages, url_filter.fit(url_filter.labelled_urls())).collect()}
    for k, (_, *want) in enumerate(URLS):
        assert [found[k].host, found[k].path, found[k].rule, found[k].verdict] == want
    assert url_filter.judge(pages.limit(0), (np.zeros(url_filter.SLOTS), 0.0)).collect() == []


def blocked(table, urls):
    """The shares of unwanted and of ordinary URLs that a model of `table` blocks."""
    model = url_filter.fit(table)
    found = url_filter.scores(*zip(*(url_filter.split(u) for u, _ in urls), strict=True), model) > url_filter.THRESHOLD
    label = np.array([x == 1 for _, x in urls])
    return found[label].mean(), found[~label].mean()


def test_url_scores_do_not_depend_on_the_batch():
    model = url_filter.fit(url_filter.labelled_urls(made_up=50))
    urls = [url_filter.split(u) for u, _ in url_filter.labelled_urls(seed=3, made_up=20)] + [("", ""), ("a", ""), ("", "/b")]
    alone = [float(url_filter.scores([h], [p], model)[0]) for h, p in urls]
    assert np.allclose(alone, url_filter.scores(*zip(*urls, strict=True), model)) and alone[-3] == 0


CLASHING = "page_id long, url string, html string, host string, path string, rule string, score double, shard long, blocks string, declared string, text string"


@pytest.mark.parametrize("operator", ["urls", "texts"])
def test_pages_of_nulls_and_clashing_columns(spark, operator):
    of = lambda df: (url_filter.judge(df, (np.zeros(url_filter.SLOTS), 0.0)) if operator == "urls" else html_main.extract(df)).collect()
    rows = of(spark.createDataFrame([(None,) * 11] * 2 + [(1, None, "<p>a</p>", "x", "y", "z", 1.0, 5, "b", "d", "t"), (2, "http://h.org/", None, *[None] * 8)], CLASHING))
    assert len(rows) == 4
    if operator == "texts":
        assert sorted(r.text for r in rows) == ["", "", "", "a"]
    else:
        assert sorted(r.host for r in rows) == ["", "", "", "h.org"]
    assert of(spark.createDataFrame([], CLASHING)) == []


def test_deep_and_broken_pages_take_time_in_proportion():
    def seconds(n, page):
        began = time.perf_counter()
        html_main.parse(page(n))
        return time.perf_counter() - began

    for page in (lambda n: "<div>" * n + "x" + "</div>" * n, lambda n: "<div>" * n + "</span>" * n, lambda n: "<b>" * n + "<p>y</p>" * n, lambda n: "<p>" * n, lambda n: "<ul><li>" * n + "z"):
        assert seconds(40_000, page) < 20 * seconds(4_000, page) + 0.2
    assert html_main.parse("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article><p>out") == (True, ["deep"])


def test_url_model_separates_its_table():
    assert blocked(url_filter.labelled_urls(), url_filter.labelled_urls()) == (1.0, pytest.approx(0, abs=0.01))


def test_url_model_on_hosts_it_has_not_seen():
    """Known words in new hosts are blocked; new hosts without any are not."""
    recall, wrong = blocked(url_filter.labelled_urls(), url_filter.labelled_urls(seed=77))
    assert recall > 0.85 and wrong < 0.01


def test_url_model_on_words_it_has_not_seen():
    """Held out by word in four folds, mates included: unknown ordinary words and hosts that mean nothing are hardly ever blocked (about 1 %, 2 % in the worst fold).  Unknown unwanted words are not known to be."""
    wrong = []
    for fold in range(4):
        part = lambda words, own, fold=fold: [w for k, w in enumerate(words) if (k % 4 == fold) == own]
        table = url_filter.labelled_urls(part(url_filter.UNWANTED, False), part(url_filter.ORDINARY, False))
        held = url_filter.labelled_urls(part(url_filter.UNWANTED, True), part(url_filter.ORDINARY, True), 300, seed=5)
        wrong.append(blocked(table, held)[1])
    assert np.mean(wrong) < 0.02


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="page">
<header><h2>Site</h2></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div class="cookie-notice">Cookies!</div><div class="ad">Buy</div>
<article><header><h1>Head &amp; <i>tail</i></h1></header><p><b>One&nbsp;&lt;two&gt;<br>three
 four<p>Five &#233; <span>six</span></p><ul><li>a<li>b</ul><form><p>Sign up</p></form><!-- no --><aside>Side</aside>
<section id="comments"><p>Nice!</p></section></article><div id="sidebar"><p>More</p></div><footer>&copy; me</footer></body></html>"""


def test_article():
    assert html_main.parse(PAGE) == (True, ["Head & tail", "One <two> three four", "Five é six", "a", "b"])


def test_main_part_and_broken_pages():
    assert html_main.parse("<body><div>x</div><main><p>a<p>b</main>") == (True, ["a", "b"])
    assert html_main.parse(None) == (False, [])
    assert html_main.parse("<p>open <b>bold") == (False, ["open bold"])
    assert html_main.parse("</div></p>text<") == (False, ["text<"])


def test_classes_have_a_vote_only():
    """No page is emptied by the words of its classes, and an article beside the main part is not the text."""
    text = "The whole text of the page stands in here, and nothing else does."
    assert html_main.parse(f'<body><div class="post promo"><p>{text}</div>') == (False, [text])
    assert html_main.parse(f'<body><h1>Title</h1><div class="social-policy"><p>{text}</div>') == (False, ["Title", text])
    assert html_main.parse(f'<body><p>{text}</p><div class="social"><p>Share this</div>') == (False, [text])
    assert html_main.parse(f"<main>{text}</main><article>teaser</article>") == (True, [text])
    assert html_main.parse(f"<main><p>lead</p><article>{text}</article></main><article>teaser</article>") == (True, [text])
    assert html_main.parse(f"<article>{text}</article><div hidden>{text}</div>") == (True, [text])
    assert html_main.parse(f'<div hidden>{text}</div><p aria-hidden="true">{text}</p>') == (False, [])
    assert html_main.parse(f'<article><p>{text}</p><div class="comments"><p>{text * 9}</div></article>') == (True, [text])


def test_suffix_array():
    rng = random.Random(1)
    for n in (0, 1, 2, 50):
        tokens = np.array([rng.randrange(3) for _ in range(n)], np.int64)
        want = sorted(range(n), key=lambda i: tokens[i:].tolist())
        assert html_main.suffix_array(tokens).tolist() == want


def test_repeated_runs_go_where_no_article_is_declared(spark):
    menu = "<div>Home About Contact us today</div>"
    rows = [(k, f"http://h{k % 2}.org/{k}", f"<body>{menu}<div>The page number {k} says {k * 7} things of its own</div><div>All rights reserved by someone</div></body>") for k in range(40)]
    rows += [(100, None, None), (101, "http://h0.org/x", ""), (102, "http://h0.org/y", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_main.extract(pages, shard_pages=8).collect()}
    assert all(found[k] == f"The page number {k} says {k * 7} things of its own" for k in range(40))
    assert (found[100], found[101]) == ("", "")
    assert found[102].startswith("Head & tail\n\nOne")
    assert html_main.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("shard_pages", [1000, 8, 1])
def test_repeats_are_counted_over_the_whole_host(spark, shard_pages):
    """A notice, and a short one, on three of 64 pages go, those on two stay, and so do those on pages of several hosts, whatever the shards."""
    rows = []
    for k in range(64):
        notes = "".join(f"<p>{t}</p>" for t, on in (("Our winter sale starts on Monday", (1, 30, 60)), ("Buy now", (2, 31, 61)), ("Two pages only say this", (3, 32)), ("Stay tuned", (4, 33))) if k in on)
        rows.append((k, "http://one.org/", f"{notes}<p>own{k} words{k} of{k} page{k} here{k}</p>"))
    rows += [(100 + k, f"http://h{k}.org/", "<p>Two pages only say this</p><p>Stay tuned</p>") for k in range(3)]
    rows += [(3, "http://one.org/", "<p>Two pages only say this</p>")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    own = lambda k: f"own{k} words{k} of{k} page{k} here{k}"
    want = [(k, "\n\n".join(["Two pages only say this"] * (k in (3, 32)) + ["Stay tuned"] * (k in (4, 33)) + [own(k)])) for k in range(64)]
    want += [(100 + k, "Two pages only say this\n\nStay tuned") for k in range(3)] + [(3, "Two pages only say this")] * 2
    found = [(r.page_id, r.text) for r in html_main.extract(pages, shard_pages=shard_pages).collect()]
    assert sorted(found) == sorted(want)


@pytest.mark.parametrize("copies", [1, 2])
def test_repeated_rows_are_one_page(spark, copies):
    pages = spark.createDataFrame([(1, "http://h.org/", "<p>only these few words stand here</p>")] * copies, "page_id long, url string, html string")
    assert [r.text for r in html_main.extract(pages).collect()] == ["only these few words stand here"] * copies


def test_stretch_is_the_best_of_all():
    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.randint(-6, 6) or 1 for _ in range(rng.randrange(9))]
        worth = lambda i, j, s=scores: sum(s[i:j]) - (j - i - 1)
        first, last = html_main.stretch(scores)
        best = max((worth(i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=0)
        assert (worth(first, last) == best) if best > 0 else (first, last) == (0, 0)


@pytest.mark.parametrize("shard_pages", [1000, 8])
def test_runs_cross_blocks(spark, shard_pages):
    """Menus of one-word blocks are runs; a sentence that articles share stays inside them; a host without repeats keeps every block."""
    menu = "".join(f"<div>{w}</div>" for w in ("Home", "News", "About", "Contact", "Help"))
    shared = "As every reader of ours knows by now"
    own = lambda k, name: " ".join(f"{name}{k}w{i}" for i in range(12))
    page = lambda k: f"{menu}<p>{own(k, 'first')}</p><p>{shared}</p><p>{own(k, 'last')}</p><div>Imprint</div><div>Privacy</div><div>Terms</div>"
    rows = [(k, "http://one.org/", page(k)) for k in range(20)]
    rows += [(100 + k, f"http://h{k}.org/", f"<h1>Title</h1>{page(k)}") for k in range(2)]
    found = {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), shard_pages=shard_pages).collect()}
    for k in range(20):
        assert found[k] == f"{own(k, 'first')}\n\n{shared}\n\n{own(k, 'last')}"
    assert all(found[100 + k].startswith("Title\n\nHome\n\nNews") and found[100 + k].endswith("Terms") for k in range(2))


@pytest.mark.parametrize("shard_pages", [1000, 8])
def test_declared_pages_are_pages_of_the_host(spark, shard_pages):
    """Runs of pages that declare their article count for one that does not; a declared part that the host repeats whole is no article where other text is, and is one where there is none."""
    menu, notice = "<div>Home About Contact us today</div>", "<main><p>We use cookies on all our pages</p></main>"
    own = lambda k: f"own{k} words{k} of{k} the{k} page{k} number{k} stand{k} here{k}"
    rows = [(k, "http://one.org/", f"{menu}<article><p>{own(k)}</p><p>Printed by our own press</p></article>") for k in range(40)]
    rows += [(100, "http://one.org/", f"{menu}<div>{own(100)}</div>")]
    rows += [(200 + k, "http://two.org/", f"{notice}<div>{own(200 + k)}</div>") for k in range(30)]
    rows += [(300 + k, "http://two.org/", f"{notice}<div>{k}</div>") for k in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html_main.extract(pages, shard_pages=shard_pages).collect()}
    want = {k: f"{own(k)}\n\nPrinted by our own press" for k in range(40)} | {k: own(k) for k in (100, *range(200, 230))}
    assert found == want | {300 + k: "We use cookies on all our pages" for k in range(3)}


def test_packed_blocks():
    blocks = [(True, "a\ud800é"), (False, "+b"), (False, "-")]
    assert html_main.unpacked(html_main.packed(blocks)) == blocks
