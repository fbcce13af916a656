"""Page text and URL verdicts."""

import re

import numpy as np
import pytest

from routepulse.llm import html_extraction, page_blocks, url_filter
from routepulse.llm.queries import URL_RULES


def text_of(page):
    return page_blocks.article(page_blocks.blocks(page), frozenset())


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("   \n ", ""),
        ("just words", "just words"),
        ("<article><h1>T&eacute;t&#233;</h1><p>a &lt;b&gt;\n  c&nbsp;d<p>e <b>f</b>g<br>h</article> after", "Tété\na <b> c d\ne fg\nh"),
        ("<nav>menu</nav><main>body<aside>side</aside><form>ask <input>me</form> tail</main><footer>end</footer>", "body\ntail"),
        ("<header>top</header><article><header><h1>title</h1></header>x<footer>by me</footer></article>", "title\nx"),
        ('<article>a<div class="ad-box">buy</div><div id="comments"><article>me too</article></div>b</article>', "a\nb"),
        ('<article>one <span class="share">tweet</span> two<p hidden>no</p><p style="display: none">no</p><p>yes</article>', "one two\nyes"),
        ("<body><script>var a='<p>x</p>'; if (a<b) {}</script><style>p{}</style><p>seen<!-- <p>not</p> --></p><noscript>no</noscript>", "seen"),
        ('<p title="a>b">quoted</p><a href=x>link</a> 1 < 2 & 3', "quoted\nlink 1 < 2 & 3"),
        ("<article>cut &am", "cut &am"),
        ("<article>never <p>closed <ul><li>one<li>two", "never\nclosed\none\ntwo"),
        ('<div class="content"><p>kept</p></div><div class="cookie-notice">gone</div>', "kept"),
        ("<script>never closed <article>x</article>", ""),
        ("<script>never closed <article>x</article> tail", ""),
        ("<p>a</p><!-- never > closed", "a"),
        ("<p>a</p> b <a hre", "a\nb"),
        ("<a" * 60_000, ""),
        ("<!" * 60_000 + "x", ""),
        ("<p>" * 20_000 + "deep" + "</div>" * 20_000, "deep"),
        ("<div>" * 3_000 + "deep", "deep"),
    ],
)
def test_text_of_a_page(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<html class="nav-closed"><body class="has-sidebar"><article>told</article></body></html>', "told"),
        ('<div id="social-history"><article>told <p>more</article></div><div class="ad-box">buy</div>', "told\nmore"),
        ('<main class="with-banner"><h1>head</h1><p>told</p><div class="share">tweet</div></main>', "head\ntold"),
        ('<div class="sidebar-left"><div itemprop="articleBody" class="social">told</div></div>', "told"),
        ('<article class="has-sidebar">told<div class="share">tweet</div><article class="comment">me too</article></article>', "told"),
        ('<main>head<div class="with-sidebar"><nav>menu</nav><article>told</article></div></main>', "head\ntold"),
        ('<span class="social"><article>told</article></span>', "told"),
        # an article that a hint is on or around gives way to one without
        ('<main><article>told</article><div id="comments"><article>me too</article></div><article class="comment">so</article></main>', "told"),
        ('<aside><article>other</article></aside><div hidden><article>not</article></div><p>told</p>', "told"),
    ],
)
def test_a_hint_does_not_lose_the_marked_article(page, text):
    assert text_of(page) == text


def test_hinted_blocks_go_where_the_host_repeats_them(spark):
    line = '<div class="cookie-notice">we use small files to remember what you like here</div><div class="nav-area"><nav>menu</nav></div>'
    pages = [(n, f"http://a.example/{n}", f'<div class="with-sidebar">{line}<p>{own(n)}</p><p hidden>no</p></div>') for n in range(6)]
    got = html_extraction.extract_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {n: own(n) for n in range(6)}


def test_suffix_array_finds_all_repeated_runs():
    dice = np.random.default_rng(4)
    for _ in range(100):
        streams = [dice.integers(2, 4, dice.integers(0, 15)).astype(np.uint64) for _ in range(dice.integers(1, 6))]
        hashes, low, high = html_extraction.repeated(streams, list(range(len(streams))))
        want = {}
        for n, stream in enumerate(streams):
            for run in html_extraction.windows(stream).tolist():
                want.setdefault(run, set()).add(n)
        assert dict(zip(hashes.tolist(), zip(low.tolist(), high.tolist(), strict=True), strict=True)) == {k: (min(v), max(v)) for k, v in want.items()}


def own(n):
    return "the page says " + " ".join(f"word{n}n{i}" for i in range(9))


def unmarked(n, line="read our weekly letter now"):
    return f"<div><p>{line}</p><p>{own(n)}</p><p>call our office any time you like</p></div>"


@pytest.mark.parametrize("part", [10, 2_000_000])
def test_boilerplate_of_a_host_goes(spark, monkeypatch, part):
    monkeypatch.setattr(html_extraction, "PART_TOKENS", part)  # parts of a host, or hosts whole
    pages = [(n, f"http://a.example/{n}", unmarked(n)) for n in range(12)]
    pages += [(20, "http://b.example/1", unmarked(20)), (21, None, unmarked(21)), (22, "no host", unmarked(22))]
    # copies of one page are one page; marked articles stay although they repeat
    pages += [(30, "http://c.example/1", unmarked(1)), (31, "http://c.example/1", unmarked(1)), (31, "http://c.example/1", unmarked(1))]
    pages += [(n, f"http://d.example/{n}", f"<article>same words in every article here</article><p>{own(n)}</p>") for n in (40, 41)]
    pages += [(50, "http://e.example", None), (51, "http://e.example", ""), (None, "http://e.example", "<p>no id</p>")]
    frame = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, text string, key int").repartition(3)
    got = html_extraction.extract_text(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == len(pages)
    found = {r.page_id: r.text for r in rows}
    both = "read our weekly letter now\n{}\ncall our office any time you like"
    for n in range(12):
        assert found[n] == own(n)
    assert found[20] == both.format(own(20))
    assert (found[21], found[22]) == (own(21), own(22))  # one host: none
    assert found[30] == found[31] == both.format(own(1))
    assert found[40] == found[41] == "same words in every article here"
    assert (found[50], found[51], found[None]) == ("", "", "no id")
    assert all(r.n_chars == len(r.text) for r in rows)


def test_near_copies_and_common_phrases_stay(spark):
    dice = np.random.default_rng(7)
    common = [" ".join(f"c{i}x{j}" for j in range(5)) for i in range(20)]

    def prose(n):
        """Natural language: frequent and rare words, and phrases that many texts have."""
        ranks = np.minimum(dice.zipf(1.3, n), 5000)
        return " ".join(dice.choice(common) if dice.random() < 0.1 else f"w{r}" for r in ranks)

    clean, pages = {}, []

    def add(host, text, around="{}"):
        clean[len(pages)] = text
        pages.append((len(pages), f"http://{host}/{len(pages)}", around.format("".join(f"<p>{t}</p>" for t in text.split("\n")))))

    # near copies of one article: alone on a host, and among other pages
    for host in ("near.example", "far.example"):
        article = prose(150)
        for date in ("monday", "tuesday", "friday"):
            add(host, f"seen on {date}\n{article}\n{prose(4)}")
    for _ in range(9):
        add("far.example", prose(60))
    line, long = "read our weekly letter now", " ".join(f"long{i}" for i in range(30))
    for _ in range(2000):
        add("big.example", f"{prose(8)}\n{dice.choice(common)}, said {prose(5)}\n{prose(40)}", f"<p>{line}</p>{{}}<p>{long}</p>")
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(8)
    found = {r.page_id: r.text for r in html_extraction.extract_text(frame).collect()}
    assert [i for i in clean if found[i] != clean[i]] == []


def test_the_array_is_built_for_marked_articles_too(spark):
    notice = "this notice stands in each of our articles and says that we remember what you like to read"
    page = "<nav>menu</nav><article><h1>Of.</h1>{}<p>" + notice + "</p></article><div class='ad'>buy {}</div>"
    hosts = dict.fromkeys(range(12), "a") | dict.fromkeys((40, 41, 42), "d") | {20: "c"}
    pages = [(n, f"http://{host}.example/{n}", page.format(f"<p>{own(n)}</p>", n)) for n, host in hosts.items()]
    # an article that is nothing but what all pages hold stays, and so do copies
    pages += [(n, f"http://b.example/{n}", f"<article><p>{notice}</p></article>") for n in (12, 13)] + [(30, "http://a.example/x", f"<article>{notice}</article>")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    found = {r.page_id: r.text for r in html_extraction.extract_text(frame).collect()}
    # a passage that few pages share is text
    kept = {n: f"Of.\n{own(n)}\n{notice}" for n in (20, 40, 41, 42)}
    assert found == {n: f"Of.\n{own(n)}" for n in range(12)} | dict.fromkeys((12, 13, 30), notice) | kept


def test_no_pages(spark):
    assert html_extraction.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


URLS = [
    None, "", "nothing", "http://", "https://EXAMPLE.com/en/1", "http://www.example.com/en/2", "http://x.www.example.com/en/3", "http://notexample.com/en/",
    "ftp://a.example.net/es/?q=/fr/", "http://b.net/fr/#x", "http://b.net/fr", "//c.net/es/", "x://y.org?z", "a://b://c.com/en/", "http://com/x", "http://com", "http://É.COM/ü",
]


def by_hand(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url[url.index("://") + 3 :]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(r), r, v) for r, v in URL_RULES for site, _, start in [r.partition("/")] if (host == site or host.endswith("." + site)) and path.startswith("/" + start)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules_as_by_hand(spark):
    rows = [(i, u, "c", "d") for i, u in enumerate(URLS)] + [(4, URLS[4], "again", None)]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, host string, template string"), URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = by_hand(URLS[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), URLS[r.page_id]


def test_templates_are_generalised_merged_and_judged(spark):
    pages, labels = [], []

    def add(path, blocked=None, host="h.org"):
        pages.append((len(pages), f"http://{host}{path}"))
        if blocked is not None:
            labels.append((len(pages) - 1, blocked))

    for n in range(60):
        add(f"/spam/{n}", 1 if n < 30 else None)
        add(f"/junk/{n}.html", 1 if n < 30 else None)
        add(f"/news/{n}", 0 if n < 30 else None)
        add(f"/blank/{n}")
        add(f"/user/{chr(97 + n % 26)}{chr(97 + n // 26)}name/wall", 1 if n % 2 else None)
    add("/spam/1", host="other.org")
    frame = spark.createDataFrame(pages, "page_id long, url string")
    known = spark.createDataFrame([*labels, (None, 1), labels[0]], "page_id long, blocked int")
    got = {r.page_id: r for r in url_filter.judge_urls(frame, [], known).collect()}
    by_path = {}
    for i, url in pages:
        by_path.setdefault(url.split("/")[2] + "/" + url.split("/")[3], set()).add(got[i].verdict)
    assert by_path == {"h.org/spam": {"block"}, "h.org/junk": {"block"}, "h.org/news": {"allow"}, "h.org/blank": {"allow"}, "h.org/user": {"block"}, "other.org/spam": {"allow"}}
    # a variable segment is one template, and alike branches are judged together
    templates = {tuple(r.template): r for r in url_filter.learn_templates(_labelled(spark, frame, known)).collect()}
    assert templates["spam", "{n}"]["shape"] == templates["junk", "{n}"]["shape"] != templates["news", "{n}"]["shape"]
    assert templates["spam", "{n}"].labelled == 60
    users = [r for t, r in templates.items() if t[0] == "user"]
    assert len({tuple(r["shape"]) for r in users}) == 1 and users[0].labelled == 30


def test_templates_that_part_at_the_fifth_segment(spark):
    pages = [(100 * k + n, f"http://h.org/site/2024/05/{n % 28}/{part}/x{n}{tail}") for k, (part, tail) in enumerate([("ads", ""), ("news", ""), ("ads", "/a/b/c"), ("news", "/a/b/c")]) for n in range(40)]
    known = spark.createDataFrame([(i, int("/ads/" in url)) for i, url in pages if i % 2], "page_id long, blocked int")
    got = url_filter.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), [], known).collect()
    assert {r.page_id: r.verdict for r in got} == {i: "block" if "/ads/" in url else "allow" for i, url in pages}
    assert {r.template for r in got if r.page_id >= 300} == {"/site/{n}/{n}/{n}/news/{x}/a/b/c"}


def _labelled(spark, frame, known):
    from pyspark.sql import functions as F

    host, path = url_filter.host_and_path(F.col("url"))
    return frame.select("page_id", host.alias("host"), path.alias("path")).join(known.dropna().distinct(), "page_id", "left")


def test_no_urls_and_no_python(spark):
    none = url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES)
    assert none.collect() == []
    plan = none._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
