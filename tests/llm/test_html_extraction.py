import re
from collections import Counter, defaultdict
from html import unescape

import pytest

from fleetmart.llm import html_extraction as ex
from fleetmart.llm import queries


def text(html):
    return " ".join(b.text for b in ex.Page(html).slots())


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here", "plain text here"),
        ("<p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#x1F600;&nbsp;x</p>", "a <b> &amp; éé😀 x"),
        ("<p>one<b>two</b> <i>three</i></p><p>four<br>five", "onetwo three four five"),
        ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes</p>", "yes"),
        ("<title>no</title><!-- <p>no</p> --><p>yes</p><!-- open <p>no", "yes"),
        ("<nav><ul><li><a href=/x>no</a></ul></nav><article><h1>T</h1><p>body</article><footer>no</footer>", "T body"),
        ("<nav><ul><li>no<article><p>left open above</p></article>", "left open above"),
        ("<body><div class='ad'>no</div><div class=\"cookie-notice\">no</div><div id=sidebarLeft>no</div><p>yes</p></body>", "yes"),
        ("<main><p>yes</p><section id='comments'><article class='comment'>no</article></section><aside>no</aside><form>no</form></main>no", "yes"),
        ("<div role=navigation>no</div><div><a href=1>no</a> | <a href=2>no</a></div><p>text with <a href=3>a link</a> in it", "text with a link in it"),
        ("<p>a < b and c > d</p><p>cut of<", "a < b and c > d cut of<"),
        ("<p>cut in a tag</p><p class='x", "cut in a tag"),
        ("<p><b>open<br><p>next</p><p>last</p>", "open next last"),
        ("<p title='a > b'>yes</p><ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", "yes x y 1 2 3"),
        ("<P CLASS=shadow>readable adverb</P>", "readable adverb"),
        ("<article>" + "<p>word</p>" * 20000 + "</article>", " ".join(["word"] * 20000)),
    ],
)
def test_pages(html, expected):
    assert text(html) == expected


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<body><form id=aspnetForm><nav>menu</nav><article><p>The article.</p></article><input><footer>foot</footer></form>", "The article."),
        ("<body><form id=aspnetForm action='/x'><main><p>One.</p><p>Two.</p><form>Your name</form></main></form>", "One. Two."),
        ("<body><form method=post><header>head</header><p>First.</p><div>Second.</div><aside>no</aside></form>", "First. Second."),
        ("<body><form method=post><div role='main'><p>Text.</p></div><p>Send</p></form>", "Text."),
        ("<p>Text.</p><form><p>Your name</p><button>Send</button></form>", "Text."),
        ("<article><p>Text.</p><form><p>Your comment</p></form></article>", "Text."),
        ("<form role=search><p>Find</p></form><p>Text.</p>", "Text."),
        ("<div><p>menu</p></div><div role='main'><p>Text.</p></div>", "Text."),
        ("<div><p>menu</p></div><div ROLE=\"MAIN\" class=x><p>Text.</p></div>", "Text."),
        ("<div data-x='role=main'><p>One.</p></div><p>Two.</p>", "One. Two."),
    ],
)
def test_forms_around_pages_and_main_roles(html, expected):
    assert text(html) == expected


def test_deep_and_crossed_tags_take_no_longer():
    n = 30_000
    for html in ("<div>" * n + "x", "<b>" * n + "<p>" * n + "x", "<div>" * n + "</p>" * n + "x", "<article>" * n + "x", "<a>" * n + "<p>" * n + "x</a>"):
        assert text(html) in ("x", "")


def test_hosts():
    hosts = ["http://A.example.com/x", "https://u:p@b.org:80/y", "//c.net?q", "ftp://d.e#f", "no host", "", None]
    assert [ex.host_of(u) for u in hosts] == ["a.example.com", "b.org", "c.net", "d.e", None, None, None]


def plain_extract(pages, least):
    """Classes from whole occurrence vectors, held in plain Python."""
    by_host = defaultdict(dict)
    for _, url, html in pages:
        if (host := ex.host_of(url)) is not None:
            page = ex.Page(html)
            blocks = Counter((b.path, b.text) for b in page.slots())
            signature = "\0".join(b.text for b in page.slots())
            own = by_host[host].setdefault(signature, Counter())
            for token, n in [*page.tags.items(), *blocks.items()]:
                own[token] = max(own[token], n)
    gone = set()
    for host, found in by_host.items():
        vectors = defaultdict(set)
        for token in {t for counts in found.values() for t in counts}:
            vectors[tuple(counts[token] for counts in found.values())].add(token)
        for vector, members in vectors.items():
            if sum(n > 0 for n in vector) >= least and any(isinstance(t, int) for t in members):
                gone |= {(host, *t) for t in members if not isinstance(t, int)}
    for i, url, html in pages:
        host = ex.host_of(url)
        yield i, url, " ".join(b.text for b in ex.Page(html).slots() if (host, b.path, b.text) not in gone)


def site():
    rows = []
    for k in range(12):
        notice = "<section class=box><h3>Read more</h3><p>Subscribers read more.</p></section>" if k % 2 else ""
        quoted = "<p>A passage that many articles quote.</p>" if k % 3 == 0 else ""
        rows.append((k, f"http://a.com/{k}", f"<article><div class=by>By our staff</div><p>Article {k}.</p>{quoted}{notice}</article>"))
    rows += [(20 + k, "http://copies.com/", "<article><div class=by>Our staff</div><p>The same.</p></article>") for k in range(9)]
    rows += [(40 + k, f"http://few.com/{k}", f"<article><div class=by>Our staff</div><p>{k}</p></article>") for k in range(4)]
    return rows + [(50, None, "<p>no host</p>"), (51, "http://a.com/51", None), (51, "http://a.com/51", None), (None, "http://a.com/52", "<p>no id</p>")]


@pytest.mark.parametrize("sent", [10, 0])
def test_template_of_a_host(spark, frame, monkeypatch, sent):
    monkeypatch.setattr(ex, "SENT_BLOCKS", sent)
    rows = site()
    pages = frame("page_id long, url string, html string", *rows).selectExpr("*", "1 as text", "2 as host", "3 as id")
    found = [tuple(r) for r in ex.extract(pages).collect()]
    assert sorted(found, key=str) == sorted(plain_extract(rows, 5), key=str)
    own = {r[0]: r[2] for r in found}
    assert own[0] == "By our staff Article 0. A passage that many articles quote." or own[0] == "Article 0. A passage that many articles quote."
    assert own[1] == "Article 1." or own[1] == "By our staff Article 1."
    assert own[20] == "Our staff The same." and own[40] == "Our staff 0" and own[50] == "no host" and own[51] == ""


def test_full_template_leaves_the_slots(frame):
    rows = [(k, f"http://a.com/{k}", f"<article><div class=by>By our staff</div><p>Article {k}.</p></article>") for k in range(6)]
    assert sorted(r["text"] for r in ex.extract(frame("page_id long, url string, html string", *rows)).collect()) == [f"Article {k}." for k in range(6)]


def test_empty_table(frame):
    assert ex.extract(frame("page_id long, url string, html string")).collect() == []


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    pages = queries.table(spark, folder, "pages").collect()
    found = {r["page_id"]: r for r in queries.QUERIES["op4_html_extraction"](spark, folder).collect()}
    assert len(found) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        plain = " ".join(unescape(re.sub(r"<(?:p|/p|br|h1|/h1)>", " ", re.sub(r"</?b>", "", inner))).split())
        assert found[r["page_id"]]["text"] == plain
        assert found[r["page_id"]]["n_chars"] == len(plain) and found[r["page_id"]]["url"] == r["url"]


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<main class='with-sidebar'><p>yes</p></main>", "yes"),
        ("<article class='post has-comments'><p>yes</p></article><div class='comments-area'><article>no</article></div>", "yes"),
        ("<div class='no-header content'><article><p>yes</p></article></div>", "yes"),
        ("<div class='sidebar'><p>no</p><article><p>the only one</p></article></div>", "the only one"),
        ("<div class='sidebar'><main><p>yes</p></main></div><div class='related-posts'><article>no</article></div>", "yes"),
        ("<article><section id='discussion'>a</section><section id='related-work'>b</section><h2 id='notice'>c</h2><p class='hidden-gem'>d</p></article>", "a b c d"),
        ("<article><h2 class='header'>a</h2><p class='search'>b</p><div class='share-buttons'>no</div><section id=comments>no</section></article>", "a b"),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> holds</p></article>", "so x = 1 2 holds"),
        ("<p title=it's>one</p><p title='a > b' id=x>two</p><p alt=5\" c=d>three</p><p>and <a href=?q=\"x>four</a> more words</p>", "one two three and four more words"),
        ("<article>a<article class='comment'>no</article>b</article>", "a b"),
        ("<footer class=menu><article>no</article></footer><div class='menu'>no</div><p>yes</p>", "yes"),
        ("<div class='topbar-left ad-slot-2'>no</div><div role=search>no</div><span class=ad>no</span><p>yes</p>", "yes"),
    ],
)
def test_names_are_taken_whole_and_spare_the_article(html, expected):
    assert text(html) == expected


def unmarked(k, body, menu="<a href=/1>Start</a>", around=""):
    return f"<body><div class=x1><div>{menu}</div></div><div class=x2><div class=x3>{body}</div>{around}</div></body>"


def by_id(rows):
    return {r["page_id"]: r["text"] for r in rows}


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_slots_of_pages_without_an_article_are_judged_by_their_host(frame, monkeypatch, sent):
    monkeypatch.setattr(ex, "SENT_BLOCKS", sent)
    teasers = ["Read the paper at home.", "Win a journey."]
    rows = []
    for k in range(6):
        first = f"<p><a href=/{k}>Story {k} begins with a link</a></p>" if k == 0 else f"<p>Story {k} begins here.</p>"
        body = f"<h2>Title {k}</h2>{first}<p>The text of story {k} goes on for a while, unlike the others.</p>"
        menu = "Start here" if k == 3 else "<a href=/1>Start</a> <a href=/2>More of it</a>"
        rows.append((k, f"http://a.com/{k}", unmarked(k, body, menu, f"<div class=x4>{teasers[k % 2]}</div>")))
    found = by_id(ex.extract(frame("page_id long, url string, html string", *rows)).collect())
    for k in range(6):
        first = f"Story {k} begins with a link" if k == 0 else f"Story {k} begins here."
        assert found[k] == f"Title {k} {first} The text of story {k} goes on for a while, unlike the others."


def test_two_pages_tell_what_is_repeated_outside_the_content(frame):
    body = "<p>Part {0} of the story, which is long enough to hold most of the page's text.</p><p>All parts share this.</p>"
    pages = [(k, f"http://a.com/{k}", unmarked(k, body.format(k), around="<div>We are hiring.</div>")) for k in range(2)]
    alone = [(9, "http://b.com/9", unmarked(9, body.format(9), around="<div>We are hiring.</div>"))]
    found = by_id(ex.extract(frame("page_id long, url string, html string", *pages, *alone)).collect())
    long = "Part {0} of the story, which is long enough to hold most of the page's text. All parts share this."
    assert [found[k] for k in range(2)] == [long.format(k) for k in range(2)]
    assert found[9] == long.format(9) + " We are hiring."


def test_kinds_of_pages_on_a_host_have_their_own_content(frame):
    rows = [(k, f"http://a.com/{k}", unmarked(k, f"<p>News {k}, all of it told at length for you.</p>", around="<div>Same.</div>")) for k in range(3)]
    rows += [(10 + k, f"http://a.com/s{k}", f"<div class=y1><p>Shop item {k}, described at length for you.</p><p>Varied {k}.</p></div>") for k in range(3)]
    rows += [(20, "http://a.com/20", "<table><tr><td>Only here.</table>")]
    found = by_id(ex.extract(frame("page_id long, url string, html string", *rows)).collect())
    assert [found[k] for k in range(3)] == [f"News {k}, all of it told at length for you." for k in range(3)]
    assert [found[10 + k] for k in range(3)] == [f"Shop item {k}, described at length for you. Varied {k}." for k in range(3)]
    assert found[20] == "Only here."


def test_characters_held_by_elements_are_sums_over_all_within():
    page = ex.Page("<div class=a>abc<p>defgh</p><div class=b><p>ij<a href=1>kl</a></p></div></div><p>m</p>")
    held, above = page.held(), page.above
    first = next(iter(above))
    assert held[0] == 3 + 5 + 2 + 1 and held[first] == 5 + 2
    assert sorted(held[p] for p in above) == [0, 0, 0, 2, 7]


def test_deep_pages_are_summed_in_one_walk():
    n = 30_000
    page = ex.Page("".join(f"<div>{k % 10}" for k in range(n)))
    assert page.held()[0] == n
