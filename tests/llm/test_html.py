import pytest
from pyspark.sql import functions as F

from lakeworks.llm import html

BODY = "<h1>Title &amp; more</h1><p>First   part\n<b>bold</b> and <a href=x>link</a>.</p><p>Second&nbsp;part<br>goes on</p><ul><li>one<li>two</ul>"
TEXT = "Title & more\nFirst part bold and link.\nSecond part goes on\none\ntwo"


def article(inner):
    return ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><p>x';</script></head><body class='has-sidebar'>"
            "<header><h2>Site</h2></header><nav><ul><li><a href=/a>A</a></ul></nav><!-- <p>no</p> --><div class='ad'>Buy</div>"
            f"<article>{inner}</article><aside>Side</aside><form><p>Name</p><input></form><footer>&copy; x</footer></body></html>")


def content_div(inner, n):
    return (f"<div id='menu{n}'><a href=a>Home</a> <a href=b>More words in links here and there</a></div><div class='page'><div class='post-{n}'>{inner}</div>"
            f"<div class='cookie-notice'>We use cookies</div></div><div class='comments'><div class='comment'><p>Great post, dear writer, really</p></div></div>")


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("plain words only", "plain words only"), ("<p>a<p>b", "a\nb"), ("<div>x<script>y", "x"), ("a < b & c <3", "a < b & c <3"),
    (article(BODY), TEXT), (article(BODY).replace("</article>", "").replace("</body></html>", ""), TEXT),
    (article("<header><h1>In</h1></header><p>x</p><section class='comments'><p>no</p></section><div class='share'>no</div>"), "In\nx"),
    (content_div(BODY, 7), TEXT), ("<main><p>m</p><article><p>a</p></article></main>", "a"), ("<main><p>m</p><form>f</form></main>", "m"),
    ("<article><p>one</p></article><article><p>two</p></article>", "one\ntwo"),
    ("<article><p>post</p></article><article class='comment'><p>reply</p></article>", "post"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><p hidden>no</p><dl><dt>t<dd>d</dl></article>", "a\nb\nc\nt\nd"),
    ("<article>" + "<div>" * 500 + "deep" + "</div>" * 500 + "</article>", "deep"),
    ("<main>" + "<div>" * 30 + "deep<aside>Side</aside><nav>Menu</nav>" + "</div>" * 30 + "</main>", "deep"),
    (f"<div><h1>Title</h1><p>{'long words ' * 30}</p><ul><li>one<li>two</ul></div>", f"Title\n{'long words ' * 29}long words\none\ntwo"),
    (f"<body><div class=a>{'intro ' * 35}</div><div class=b>{'rest ' * 65}</div></body>", f"{'intro ' * 34}intro\n{'rest ' * 64}rest"),
    ("<article><p>x</p><div class='notice-board'>kept</div><div class='site-notice'>no</div></article>", "x\nkept"),
    ("<article><p title=\"a > b\">q</p><img alt='x'/><p>r</article>", "q\nr"),
])
def test_single_pages(source, text):
    assert html.main_text(source, None) == text


def test_unclosed_markup_takes_linear_time():
    assert html.main_text('<a "' * 50_000 + "x", None).endswith("x")
    assert html.main_text("<p>" * 20_000 + "x" * 1_000_000, None) == "x" * 1_000_000


def test_template_of_a_host(spark):
    """The slot is learned from the host; a page with little text of its own still gives just that."""
    rows = [(i, f"http://Site.net/{i}", content_div(f"<p>{' '.join(f'word{i}{j}' for j in range(40))}</p>", i)) for i in range(8)]
    rows += [(8, "http://site.net/8", content_div("<p>tiny</p>", 8)), (9, "http://other.net/", article(BODY)), (10, None, None), (11, "x", ""),
             (9, "http://other.net/", article(BODY))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "_host": F.lit("x")})
    out = html.extract(pages)
    assert out.columns == ["page_id", "url", "_host", "text", "n_chars"]
    got = sorted((r.page_id, r.text, r.n_chars) for r in out.collect())
    assert len(got) == 13 and got[8] == (8, "tiny", 4) and got[0][1] == " ".join(f"word0{j}" for j in range(40))
    assert got[9:11] == [(9, TEXT, len(TEXT))] * 2 and got[11:] == [(10, "", 0), (11, "", 0)]
    assert html.extract(pages.where("false")).collect() == []


def test_vectors_group_tokens_that_stand_together(spark):
    rows = [(f"http://h.net/{i}", f"<div><p>a</p>{'<ul><li>x</li></ul>' * (i % 2)}</div>") for i in range(6)]
    counts = html.token_counts(spark.createDataFrame(rows, "url string, html string"), "url", "html").collect()
    by_path = {r.path.split("\x01")[-1]: (r.pages, r.n, r.vector) for r in counts}
    assert by_path["ul"] == by_path["li"] != by_path["p"] and by_path["p"] == by_path["div"] and by_path["div"][:2] == (6, 6)


def test_wording_of_the_template_is_left_out(spark):
    """Words that all pages have are the template's; copies of a page say nothing about that, and a marked article is whole."""
    def page(i):
        return f"<div class=top>Welcome to our place on the web</div><div class=mid><h1>Title {i}</h1><p>{' '.join(f'w{i}x{j}' for j in range(30))}</p></div><div class=end>All rights</div>"

    rows = [(i, f"http://h.net/{i}", page(i)) for i in range(6)] + [(10 + i, f"http://copies.net/{i}", page(1)) for i in range(4)]
    rows += [(20 + i, f"http://marked.net/{i}", f"<article><h2>Summary</h2><p>text {i}</p></article>") for i in range(4)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == f"Title {i}\n{' '.join(f'w{i}x{j}' for j in range(30))}"
    assert all(got[10 + i].split("\n")[1] == "Title 1" for i in range(4))
    assert all(got[20 + i] == f"Summary\ntext {i}" for i in range(4))
