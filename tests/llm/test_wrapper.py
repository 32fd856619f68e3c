import random
import re

import duckdb

from tempestry.llm import wrapper
from tests.llm.cases import SF, prose


def table(spark, rows):
    full = [(i, u, h, "x", "y", "z", 3) for i, u, h in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, text string, host string, labels string, n_chars long")


def page(i, body, nav="", footer="", extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>T {i}</title><style>p{{a:b}}</style><script>var t='</p><p>x';</script></head>"
        f"<body><nav><ul>{nav}</ul></nav><div class='ad'>Buy {i}!</div>{extra}<article>{body}</article><footer>&copy; {footer}</footer></body></html>"
    )


def texts(spark, rows):
    got = wrapper.extract_text(table(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return {r.page_id: r.text for r in rows}


def test_articles_of_the_table(spark):
    got = {r.page_id: r.text for r in wrapper.extract_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for i, html in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", html, re.S).group(1)
        from html import unescape

        want = " ".join(unescape(re.sub(r"</?(?:b|i|em|a)\b[^>]*>", "", re.sub(r"<(?:/?(?:p|h1)|br)>", " ", inside))).split())
        assert got[i] == want


def test_blocks_references_and_white_space(spark):
    body = "<h1>One &amp;\n two</h1><p>A<b>b</b>c &lt;x&gt; &#233;&#x41;<br>next\t line<p>open <i>still</p> tail <!-- no --> end"
    got = texts(spark, [(1, "http://a.b/1", page(1, body)), (2, "http://a.b/2", page(2, "<p>Other"))])
    assert got == {1: "One & two Abc <x> éA next line open still tail end", 2: "Other"}


def test_parts_that_are_no_article(spark):
    apart = "<div class='cookie-notice'>Accept</div><aside>Side</aside><form><label>Mail</label><input></form><header>Top</header>"
    comments = "<section id='comments'><p>First!</p></section><div role='navigation'>more</div><div hidden>h</div>"
    rows = [(i, f"http://h.c/{i}", page(i, f"<p>Story {i} goes on.</p>{comments}", f"<li>m{i}", "c", apart)) for i in range(6)]
    assert texts(spark, rows) == {i: f"Story {i} goes on." for i in range(6)}


def test_constant_nodes_are_template_where_only_slots_vary(spark):
    """No element says what it is; only the alignment of the pages does."""
    def plain(i):
        return f"<html><body><div><div>The Daily Example</div><div>Home World Sport</div></div><div><p>Report {i} from place {i * 7} and on.</p><p>Follow us</p></div></body></html>"

    rows = [(i, f"http://one.org/{i}", plain(i)) for i in range(8)]
    assert texts(spark, rows) == {i: f"Report {i} from place {i * 7} and on." for i in range(8)}


def test_copies_of_a_page_do_not_turn_its_article_into_template(spark):
    rows = [(i, f"http://c.org/{i}", page(0, "<p>The same long story.</p>")) for i in range(9)]
    rows += [(9, "http://c.org/9", page(1, "<p>Another.</p>"))]
    assert texts(spark, rows) == {**{i: "The same long story." for i in range(9)}, 9: "Another."}


def test_awkward_pages(spark):
    deep = "<div>" * 400 + "<p>deep" + "</div>" * 400
    rows = [
        (1, None, None), (None, "x", ""), (2, "http://h/", "<"), (3, "http://h/", "plain text only"), (4, "http://h/", "<p"),
        (5, "http://h/", "<article>cut &am"), (6, "http://h/", "</p></div>stray<td>cell"), (7, "http://h/", "<!-- open"),
        (8, "http://h/", "<script>open"), (9, "http://h/", deep), (10, "http://h/", "<p a='b>c'>quoted"), (11, "http://h/", page(1, "<p>" + "w " * 50_000)),
        (11, "http://h/", "<p a='b>broken"), (12, "http://h/", "a < b <p>c > d"),
    ]
    got = wrapper.extract_text(table(spark, rows)).collect()
    by_id = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert by_id[1] == by_id[None] == by_id[7] == by_id[8] == ""
    assert by_id[3] == "plain text only" and by_id[9] == "deep" and by_id[10] == "quoted" and by_id[5] == "cut &am"
    assert by_id[12] == "a < b c > d"
    assert wrapper.extract_text(table(spark, rows).limit(0)).count() == 0


def test_alignment_takes_the_largest_match():
    template = wrapper.shape(["#page", "div", "p", "p", "ul", "li"], [-1, 0, 1, 1, 0, 4])
    other = wrapper.shape(["#page", "h1", "div", "p", "ul", "li", "li"], [-1, 0, 0, 2, 0, 4, 4])
    found = wrapper.align(template, other)
    assert found[0] == 0 and found[1] == -1 and found[2] == 1 and found[4] == 4
    assert sum(x >= 0 for x in found) == 5


def test_long_lists_of_children_have_the_largest_match():
    """In-order first fit loses all children before a label that stands far right."""
    kinds = ["p", "ul", "table", "h2", "pre"]
    many = [kinds[i * i % 5] for i in range(400)]
    template = wrapper.shape(["#page", "div.first", *many, "div.last"], [-1] + [0] * 402)
    other = wrapper.shape(["#page", "p", *many[3:], "div.last", "div.first", "pre"], [-1] + [0] * 401)
    found = wrapper.align(template, other)
    assert sum(x >= 0 for x in found) == 1 + 1 + 397 + 1
    assert found[399] == 402


def slow_size(tl, below_t, a, pl, below_p, b):
    if tl[a] != pl[b]:
        return 0
    best = [[0] * (len(below_p[b]) + 1)]
    for x in below_t[a]:
        row = [0]
        for k, y in enumerate(below_p[b]):
            row.append(max(best[-1][k + 1], row[k], best[-1][k] + slow_size(tl, below_t, x, pl, below_p, y)))
        best.append(row)
    return best[-1][-1] + 1


def test_matches_of_random_trees_are_valid_and_largest():
    r = random.Random(6)

    def tree(n):
        return wrapper.shape(["#page", *(r.choice("abc") for _ in range(n))], [-1, *(r.randrange(max(0, i - 4), i + 1) for i in range(n))])

    for _ in range(150):
        (tl, tp), (pl, pp) = template, other = tree(r.randint(0, 40)), tree(r.randint(0, 40))
        to = wrapper.align(template, other)
        pairs = [(a, b) for b, a in enumerate(to) if a >= 0]
        assert len(pairs) == slow_size(tl, wrapper._children(tp), 0, pl, wrapper._children(pp), 0)
        assert all(tl[a] == pl[b] and (not b or to[pp[b]] == tp[a]) for a, b in pairs)
        for x in range(len(pl)):
            kept = [to[b] for b in wrapper._children(pp)[x] if to[b] >= 0]
            assert kept == sorted(set(kept))


def test_parts_below_the_depth_limit_stay_apart():
    inner = "<p>kept<nav>menu <ul><li>one</ul></nav><div class='ad'>buy<div>now</div></div><aside>side</aside><p>also</p>"
    html = "<div>" * 300 + inner + "</div>" * 300 + "<p>end</p>"
    labels, parents, blocks = wrapper.parse(html)
    off = wrapper.apart_all(labels, parents)
    assert [t for node, t in blocks if not off[node]] == ["kept", "also", "end"]
    assert parents[blocks[-1][0]] == 0


def test_leads_tables_and_second_articles_are_kept(spark):
    """Prose beside the part that holds most of it belongs to the article too."""
    def nested(i):
        body = f"<div class='body'><p>{prose(i, 90)}</p></div>"
        return f"<body><div>Daily</div><main><h1>Head {i}</h1><p class='lead'>Lead of {i}.</p>{body}</main></body>"

    def listed(i):
        items = "".join(f"<li>{prose(50 * i + k, 9)}</li>" for k in range(12))
        return f"<body><div>Daily</div><article><p>Before {i}.</p><ul>{items}</ul><p>After {i}.</p></article></body>"

    def two(i):
        return f"<body><div>Daily</div><article><p>{prose(i, 80)}</p></article><article><p>Second {i}.</p></article></body>"

    rows = [(100 * k + i, f"http://{k}.org/{i}", f(i)) for k, f in enumerate((nested, listed, two)) for i in range(6)]
    got = texts(spark, rows)
    for i in range(6):
        assert got[i] == f"Head {i} Lead of {i}. {prose(i, 90)}"
        assert got[100 + i] == " ".join([f"Before {i}.", *(prose(50 * i + k, 9) for k in range(12)), f"After {i}."])
        assert got[200 + i] == f"{prose(i, 80)} Second {i}."


def test_names_of_what_holds_the_article_do_not_count(spark):
    wraps = [
        "<body class='has-sidebar'><div>Daily</div>{}</body>",
        "<body><div>Daily</div><div id='content-with-sidebar'>{}</div></body>",
        "<body><div>Daily</div><article class='post has-comments'>{}</article></body>",
        "<body><form action='/x'><div>Daily</div>{}</form></body>",
        "<body><main class='search widget'><div>Daily</div>{}</main></body>",
        "<body><div>Daily</div><article><h1>Top</h1><div class='share-widget'>{}</div></article></body>",
    ]

    def inner(i):
        apart = f"<div class='ad'>Buy {i}!</div><form>Mail {i}</form>"
        return f"<p>{prose(i, 40)}</p>{apart}<section id='comments'><article><p>{prose(70 + i, 300)}</p></article></section>"

    rows = [(100 * k + i, f"http://{k}.net/{i}", w.format(inner(i))) for k, w in enumerate(wraps) for i in range(6)]
    got = texts(spark, rows)
    assert got == {100 * k + i: prose(i, 40) for k in range(len(wraps)) for i in range(6)}


def test_parts_longer_than_an_article_stay_apart():
    for part in ("<div class='sidebar'>{}</div>", "<div class='ad'>{}</div>", "<section class='comment-list'>{}</section>", "<form>{}</form>"):
        html = "<main><article><p>Short.</p></article>" + part.format(prose(1, 500)) + "</main>"
        labels, parents, _ = wrapper.parse("")
        assert wrapper.main_text(html, [(0, (tuple(labels), tuple(parents)))], [frozenset()]) == "Short."


def test_one_odd_page_does_not_decide_for_its_host(spark):
    """Whatever page has the smallest hash: the template is a page of the common shape."""
    def story(i, k):
        return f"<body><div>The Daily {k}</div><div><p>{prose(i, 30)}</p></div><div>Imprint of {k}</div></body>"

    rows = [(100 * k + i, f"http://{k}.org/{i}", story(100 * k + i, k)) for k in range(12) for i in range(12)]
    rows += [(100 * k + 50, f"http://{k}.org/x", f"<body><h1>Error {k}</h1><pre>not found</pre></body>") for k in range(12)]
    got = texts(spark, rows)
    for i, _, _ in rows:
        assert got[i] == (f"Error {i // 100} not found" if i % 100 == 50 else prose(i, 30))


def test_shapes_of_a_host_have_templates_of_their_own(spark):
    def story(i):
        return f"<body><div>Daily</div><section><p>{prose(i, 30)}</p></section><div>Imprint</div></body>"

    def blog(i):
        return f"<body><table><tr><td>Blog of the week<td>{prose(i, 30)}</table><p>Thanks for reading</p></body>"

    rows = [(i, f"http://two.org/{i}", (blog if i % 3 == 0 else story)(i)) for i in range(60)]
    got = texts(spark, rows)
    assert got == {i: prose(i, 30) for i in range(60)}


def test_names_inside_an_article_that_may_be_its_subject(spark):
    def page_of(i):
        parts = "".join(f"<div class='{c}'>{c} {prose(i * 7 + k, 12)}</div>" for k, c in enumerate(("alert", "share-price", "search-results")))
        apart = f"<div class='ad'>Buy {i}!</div><div class='share'>Share this</div><div class='cookie-alert'>Take {i}</div>"
        side = f"<div class='alert'>Offer {i}</div><div class='search-results'>Find {i}</div>"
        return f"<body>{side}<article><h1>Head {i}</h1>{parts}{apart}<p>{prose(i, 30)}</p></article></body>"

    got = texts(spark, [(i, f"http://s.org/{i}", page_of(i)) for i in range(8)])
    for i in range(8):
        inner = [f"{c} {prose(i * 7 + k, 12)}" for k, c in enumerate(("alert", "share-price", "search-results"))]
        assert got[i] == " ".join([f"Head {i}", *inner, prose(i, 30)])


def test_signatures_see_kinds_of_parts_and_not_their_number():
    sign = lambda html: wrapper.signature(*wrapper.parse(html)[:2])
    one = sign("<body><div id=x><nav>a</nav><article><p>b</article></div></body>")
    assert one == sign("<head><title>t</title></head><body><div id=x><nav>a</nav><article><p>b<p>c<ul><li>d</ul></article><article>e</article></div></body>")
    assert one != sign("<body><div id=y><nav>a</nav><article><p>b</article></div></body>")
    assert one != sign("<body><div id=x><nav>a</nav><article><p>b</article><footer>f</footer></div></body>")
    assert sign("") == sign("text") and sign("<body>" + "<div>" * 300) != sign("")
