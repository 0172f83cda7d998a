from hypothesis import given, strategies as st

from agencylens.llm import html_text
from agencylens.llm.html_text import main_blocks, sections

LONG = "A paragraph that is long enough to be the main text of a page, whatever else there is around it, for it goes on."


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_sections_run_from_rise_to_dive():
    assert sections([0, 5, 90, 2, 0, 0, 0, 0, 30, 0]) == [(1, 4)]
    assert sections([0, 0, 90, 0, 0, 70, 60, 1]) == [(2, 8)]
    assert sections([90, 0, 0, 0, 90]) == [(0, 1), (4, 5)]
    assert sections([0, 3, 0]) == [(1, 2)]
    assert sections([]) == [] and sections([0, 0]) == []


def test_article_without_its_surroundings():
    html = page(
        "<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div id='cookie-notice'>We use cookies</div>"
        f"<article><header><h1>Title</h1></header><p>{LONG}</p><!-- <p>no</p> --><div class='ad'>Buy</div><aside>See also</aside>"
        "<p>Short &amp; <b>bo</b>ld&nbsp;&eacute;<br>next\n\t line</p><form><p>Mail?</p></form><script>var a='<p>x</p>'</script><style>p{}</style>"
        "<section class='comments'><p>Reader: nice</p></section><p>End.</p></article><footer>&copy; us</footer>"
    )
    assert main_blocks(html) == ["Title", LONG, "Short & bold é", "next line", "End."]


def test_page_without_an_article_element():
    html = page(f"<div class='menu'><a>One</a><a>Two</a></div><ul><li><a>Link one</a></li><li><a>Link two</a></li></ul><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div class=footer>foot</div>")
    assert main_blocks(html) == ["Title", LONG, "Short.", LONG]


def test_other_articles_are_not_the_article():
    related = f"<div class='related-posts'><article><h2>Other</h2><p>{LONG}</p></article></div>"
    comment = f"<article class='comment'><p>Reader: {LONG}</p></article>"
    html = page(f"<div class='layout with-sidebar'><main class='has-comments'><p>{LONG}</p><p>End.</p>{comment}</main>{related}</div>")
    assert main_blocks(html) == [LONG, "End."]
    assert main_blocks(page(f"<div class='sidebar-left'><article><p>{LONG}</p></article></div>")) == [LONG]


def test_damaged_pages():
    assert main_blocks(page(f"<article><p>{LONG}<p>a < b &am")[:-14]) == [LONG, "a < b &am"]
    assert main_blocks(f"<article><p>{LONG}</p><p class='x") == [LONG]
    assert main_blocks(f"<nav><ul><li>never closed<article><p>{LONG}</article>") == [LONG]
    assert main_blocks(None) == main_blocks("") == main_blocks("<html></html>") == []
    assert main_blocks("just text") == ["just text"]
    assert len(main_blocks("<article>" + "<p>word</p>" * 50_000)) == 50_000
    assert main_blocks("<p " + "\"a'" * 50_000) == []


def test_report(spark):
    rows = [(1, "u", page(f"<article><p>{LONG}</p><p>é</p></article>"), "c"), (1, "u", page(f"<article><p>{LONG}</p><p>é</p></article>"), "c"), (2, None, None, None), (None, "u", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, blocks string")
    got = sorted(map(tuple, html_text.extraction_report(pages).collect()), key=str)
    assert got == sorted([(1, "u", LONG + " é", len(LONG) + 2)] * 2 + [(2, None, "", 0), (None, "u", "", 0)], key=str)
    assert html_text.extraction_report(pages.limit(0)).collect() == []


def test_pages_of_the_tables(spark, small):
    """Held against the pages' own template: the blocks of the article element."""
    import re
    from html import unescape

    pages = spark.read.parquet(f"{small}/pages.parquet")
    for row in pages.join(html_text.extraction_report(pages), "page_id").collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", row["html"], re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>?", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", body))
        assert row["text"] == " ".join(b for b in blocks if b)


def by_definition(weights, window=3, surge=80, share=0.25):
    """Lines of sections, each cut out by looking at every window of the page."""
    rising = [any(weights[k] for k in range(i, min(i + window, len(weights)))) for i in range(len(weights))]
    groups, kept = [], []
    for i, up in enumerate(rising):
        if up and i and rising[i - 1]:
            groups[-1].append(i)
        elif up:
            groups.append([i])
    tops = [max(sum(weights[i : i + window]) for i in g) for g in groups]
    masses = [sum(weights[i] for i in g) for g in groups]
    for g, top, mass in zip(groups, tops, masses, strict=True):
        if top > surge or (max(tops) <= surge and mass >= share * max(masses)):
            kept += [i for i in g if any(weights[g[0] : i + 1])]
    return kept


@given(st.lists(st.sampled_from([0, 0, 0, 5, 20, 40, 90]), max_size=30))
def test_sections_equal_their_definition(weights):
    assert [i for a, b in sections(weights) for i in range(a, b)] == by_definition(weights)


def test_every_section_that_surges_is_kept():
    stripped = "<div class='share'>Share</div><div class='ad'>Buy</div><div class='newsletter'>Mail</div>"
    html = page("".join(f"<p>{LONG}</p>" for _ in range(40)) + stripped + f"<p>{LONG}</p><p>End.</p>")
    assert main_blocks(html) == [LONG] * 41 + ["End."]


def test_ids_of_an_article_are_anchors():
    html = page(f"<article><p>{LONG}</p><section id='discussion'><h2 id='search-results'>Results</h2><p>{LONG}</p></section><section id='related-work'><p>More.</p></section><section id='comments'><p>Reader: no</p></section><div id='newsletter'>Mail</div></article>")
    assert main_blocks(html) == [LONG, "Results", LONG, "More."]


def test_paragraphs_of_links_belong_to_the_text_around_them():
    first = "As <a>this much longer title of another page, which all of it is a link, and a second one</a> said here before:"
    html = page(f"<ul><li><a>Home</a> |</li><li><a>About</a></li></ul><p>{first}</p><p>{LONG}</p><p><a>{LONG}</a></p><p>{LONG}</p>")
    plain = "As this much longer title of another page, which all of it is a link, and a second one said here before:"
    assert main_blocks(html) == [plain, LONG, LONG, LONG]
