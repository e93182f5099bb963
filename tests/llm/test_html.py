"""Main text of pages: templates with known texts, odd markup, and the vote of hosts."""

import pytest

from recspark.llm import html_text

PROSE = "Long enough prose, with commas, to be what the page is about. "
PAGES = {
    "plain": ("<p>One <b>b</b>old<br>line<p>Two", "One bold line Two"),
    "entities": ("<p>a &amp; b &lt;i&gt; &#39;q&#x27; caf&eacute; x&nbsp;y &am z&ampq</p>", "a & b <i> 'q' café x y &am z&q"),
    "inline": ("<p>w<i>or</i>d <a href='x'>li</a>nk\n\t end</p>", "word link end"),
    "raw": ("<article><script>if (a<b) { '</p>' }</script><style>p > a {}</style><p>kept</p><textarea>no</textarea></article>", "kept"),
    "comment": ("<p>a<!-- <p>no</p> -->b<!-->c<!-- -- >d--!>e</p>", "abce"),
    "odd quotes": ("<p title=it's>one</p><p title='a>b' class=\"x\">two</p>", "one two"),
    "less than": ("<p>1 < 2 and 3 <4 </ x> <? y> end</p>", "1 < 2 and 3 <4 end"),
    "lists": ("<ul><li>a<li>b<p>c<li>d</ul>", "a b c d"),
    "table": ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    "unclosed head": ("<head><meta charset=x><title>t</title><p>text</p>", "text"),
    "body in head": ("<html><head><title>t</title><body class=no-sidebar><p>text", "text"),
    "end tags": ("</div></p><p>a</b></p></article>b", "a b"),
    "only links": ("<ul><li><a href=a>a</a></ul>", ""),
    "blanks": (" \n <p> &nbsp; </p>", ""),
    "cut": ("<article><p>kept</p><p class='x", "kept"),
    "unclosed script": ("<p>kept</p><script>rest <p>no</p>", "kept"),
    "no markup": ("just text", "just text"),
    "nothing": ("", ""),
}
BOILERPLATE = (
    "<!DOCTYPE html><html><head><title>t</title></head><body><header>site</header><nav><ul><li><a>menu</a></ul></nav>"
    "<div class='cookie-notice'>We use cookies</div><div>bare banner text</div><main><article class='post-17'><h1>Title</h1>"
    f"<header>by me</header><p>{PROSE}</p><div class=adSlot><p>Buy now, buy this, buy that.</p></div><section><p>{PROSE}</p>"
    "<aside>see</aside><p class=notice>old</p><form><label>q</label><p>ask</p></form></section><footer>tags</footer>"
    "<div id=comments><article class=comment><p>First, said a reader, at length.</p></article></div></article></main>"
    "<div role=complementary>more</div><footer>&copy;</footer></body></html>"
)


@pytest.mark.parametrize("name", PAGES)
def test_texts(name):
    source, wanted = PAGES[name]
    assert html_text.main_text(source, None) == wanted


def test_boilerplate_goes():
    assert html_text.main_text(BOILERPLATE, None) == f"Title {PROSE}{PROSE}".strip()
    assert html_text.vote(BOILERPLATE)[0] == "html>body>main>article.post-#"


def test_long_pages():
    deep = "<div>" * 3000 + PROSE + "</div>" * 3000
    assert html_text.main_text(deep, None) == PROSE.strip()
    many = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    assert html_text.main_text(many, None) == (PROSE * 20_000).strip()
    assert html_text.main_text("<p " * 50_000 + ">x", None) == "x"


SCHEMA = "page_id bigint, url string, html string, text int, host string, winner string, n bigint"


def test_hosts_vote(spark):
    inner = "<body><div class='page p1'><div class=story-{i}><p>{prose}</p></div><div class=rail>{rail}</div></div></body>"
    usual = [inner.format(i=i, prose=PROSE * 4, rail="<a>x</a>") for i in range(5)]
    # alone, this page would take the rail for text
    odd = inner.format(i=77, prose=PROSE, rail="Some words of a shop, about prices. ")
    other = f"<body><section><p>{PROSE}</p></section></body>"
    rows = [(i, "http://a.org/x", h) for i, h in enumerate(usual + [odd, other])]
    rows += [(20, None, odd), (21, "a.org", odd), (22, "http://b.org", None), (23, "http://b.org", ""), (24, "http://A.org?q", odd), (0, "http://a.org/x", usual[0])]
    pages = spark.createDataFrame([(*r, 7, "h", "w", 3) for r in rows], SCHEMA).repartition(3)
    found = html_text.with_main_text(pages)
    assert set(found.columns) == {*pages.columns, "n_chars"}
    got = found.collect()
    assert len(got) == len(rows) and {r.host for r in got} == {"h"} and {r.winner for r in got} == {"w"}
    texts = {r.page_id: r.text for r in got}
    assert html_text.main_text(odd, None) != PROSE.strip()
    assert texts[5] == texts[24] == PROSE.strip() and texts[6] == PROSE.strip() and texts[0] == (PROSE * 4).strip()
    assert texts[20] == texts[21] == html_text.main_text(odd, None) and texts[22] == texts[23] == ""
    assert all(r.n_chars == len(r.text) for r in got)
    won = html_text.winners(pages.withColumn("_host_", html_text.host_and_path("url")[0]), "_host_", "html").collect()
    assert [(r["_host_"], r.winner, r.n) for r in won] == [("a.org", "html>body>div.p#.page>div.story-#", 9)]


def test_empty(spark):
    assert html_text.with_main_text(spark.createDataFrame([], SCHEMA)).count() == 0
