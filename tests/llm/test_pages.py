"""Main text of pages: exhaustive cuts, pages with their truth, and markup that is hard to read."""

import html
import itertools
import random
import re
from math import log

import pytest

from stockpulse.llm import page_text as pt
from stockpulse.llm import queries

SF = "/root/testdata/sf0.01"
PRIOR_GAINS = {(f, b): round(100 * log((p / sum(s)) / ((1 - p) / sum(1 - x for x in s)))) for f, s in pt.PRIOR.items() for b, p in enumerate(s)}
EVEN = {(f, b): 0 for f, shares in pt.PRIOR.items() for b in range(len(shares))}


def test_cut_is_the_cheapest_with_the_most_content():
    rng = random.Random(5)
    for _ in range(400):
        n = rng.randint(1, 9)
        gains = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 4)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.6]
        got = pt.minimum_cut(gains, edges)
        cost = lambda x: sum(abs(g) for g, c in zip(gains, x) if (g > 0) != c and g) + sum(c for a, b, c in edges if x[a] != x[b])
        every = [list(x) for x in itertools.product([False, True], repeat=n)]
        least = min(map(cost, every))
        assert cost(got) == least
        assert got == [any(x[i] for x in every if cost(x) == least) for i in range(n)]
        tied = [{} for _ in range(n)]     # the flow alone, without what is settled before it
        for a, b, c in edges:
            tied[a][b] = tied[b][a] = c
        assert pt.maximum_flow(list(range(n)), gains, tied) == got


def test_cut_of_a_large_page():
    rng = random.Random(1)
    n = 60_000
    gains = [rng.randint(-150, 150) for _ in range(n)] + [0] * 300
    edges = [(i, i + 1, 120) for i in range(n - 1)] + [(i, n + i // 200, 100) for i in range(n)]
    assert len(pt.minimum_cut(gains, edges)) == n + 300


def truth(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())


def test_given_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op11_minimum_cut_text"](spark, SF).collect()
    assert len(got) == len(pages)
    assert all(r["text"] == truth(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in got)


STORY = ["The council met on Tuesday, and it voted for the new bridge after a long debate.",
         "Supporters said that the old crossing could not carry the traffic of another decade, let alone two.",
         "Short one.", "Opponents, who had asked for a tunnel, left the room before the count was over."]
AROUND = {
    "semantic": "<header><a href=/>Daily</a></header><nav><ul><li><a href=a>News</a><li><a href=b>Sport</a></ul></nav><main><article><h1>Bridge</h1>{p}</article></main>"
                "<aside><p>Most read stories, chosen by our readers this week.</p></aside><footer><p>All rights reserved, 2024. Contact us for more.</p></footer>",
    "classes": '<div id="topbar"><a href="/">Daily</a> | <a href="/l">Log in</a></div><div class="cookie-notice"><p>We use cookies to make this site work, and to learn how you use it.</p></div>'
               '<div class="post-content"><h2>Bridge</h2>{p}</div><div id="comments"><div class="comment"><p>I think that this is a very bad idea, and I have said so for years.</p></div></div>'
               '<div class="sidebar-right"><p>Subscribe to our letter, it is free and comes each week.</p></div>',
    "comments inside": '<article><h1>Bridge</h1>{p}<section class="comments-area"><article class="comment"><p>A long remark of a reader, with several words in it, that goes on.</p></article>'
                       '<article class="comment"><p>Another one, just as long as the first, and as angry as that.</p></article></section></article>',
    "one form": '<body class="has-sidebar comments-open"><form id="aspnetForm"><div class="menu"><a href=x>Home</a></div><article class="post comments-open"><h1>Bridge</h1>{p}</article>'
                '<div class="ad"><p>Buy one now, and get another one for free today.</p></div></form>',
    "plain": '<table><tr><td><a href=a>Home</a> <a href=b>About</a> <a href=c>Contact</a></td></tr><tr><td><h1>Bridge</h1>{p}</td></tr><tr><td><a href=i>Imprint</a> <a href=p>Privacy</a></td></tr></table>',
    "related cards": '<article><h1>Bridge</h1>{p}</article><section class="related-posts"><article><p>Another story that you may like to read, from last week.</p></article></section>',
}


@pytest.mark.parametrize("kind", AROUND)
def test_article_out_of_common_layouts(kind):
    page = "<!doctype html><html><head><title>Bridge - Daily</title></head>" + AROUND[kind].format(p="".join(f"<p>{x}</p>\n" for x in STORY))
    assert pt.page_text(page, PRIOR_GAINS)[0] == " ".join(["Bridge", *STORY])


@pytest.mark.parametrize("source,want", [
    ("<p>a &lt; b &amp;&nbsp; c &#233;&eacute &copy;</p>", "a < b & c éé ©"),
    ("<p>one\n\t two</p><p>three<br>four<p>five", "one two three four five"),
    ("<p>in<b>si</b>de <i>x</i><!-- no --><!-->y</p>", "inside xy"),
    ("<p>x</p><script>if (a<b) '</p>'</script><style>p{}</style><noscript>no</noscript><p>y</p>", "x y"),
    ("<p title=\"a>b\" data-x='</p>'>kept</p>", "kept"),
    ("<p>a < b and 3<4 </> <?php x ?><!x>end</p>", "a < b and 3<4 end"),
    ("<p>text <a href=x", "text"), ("<p>video <video>none", "video none"), ("<p>x</p><script>never closed <p>y</p>", "x"),
    ("<ul><li>eins<li>zwei<ul><li>drei</ul><li>vier</ul>", "eins zwei drei vier"),
    ("plain text without any markup at all", "plain text without any markup at all"), ("", ""), ("<html></html>", ""), ("</div></p><p>x", "x"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<DIV><P>Großes</P></DIV>", "Großes"), ("<head><title>t</title><p>body</p>", "body"),
])
def test_reading(source, want):
    assert pt.page_text("<article>" + source if source else source, EVEN)[0] == want


def test_edges(spark):
    long = "<article>" + "".join(f"<p>Paragraph {i} of a very long page, which goes on and on.</p>" for i in range(40_000)) + "</article>"
    deep = "<div>" * 30_000 + "<p>deep down there is a sentence, and it stays.</p>"
    rows = [(1, "u", None, 7), (2, None, "", None), (2, None, "", None), (None, "v", "<article><p>x</p></article>", 1), (4, "w", long, 2), (5, "w", deep, 2), (6, "w", "<a <a <a " * 20_000, 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    gains = pt.fit_blocks(df)
    out = pt.extract_text(df, gains)
    assert out.columns == ["page_id", "url", "html", "main_text", "n_chars", "kept_blocks", "page_blocks"]
    got = sorted(((r["page_id"] or 0, r["main_text"]) for r in out.collect()), key=lambda r: r[0])
    assert [g[1] for g in got if g[0] in (0, 1, 2, 6)] == ["x", "", "", "", ""]
    assert len(dict(got)[4].split()) == 40_000 * 12 and dict(got)[5].startswith("deep down")
    empty = df.limit(0)
    assert pt.extract_text(empty, pt.fit_blocks(empty)).collect() == []
