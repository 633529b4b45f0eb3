import re
from html import unescape

from candlewick.llm import html_text
from candlewick.llm.html_text import main_text


def test_query_against_markup(spark, sf_dir):
    """The generated pages hold their text in one article element."""
    out = {r.page_id: r for r in html_text.op2_tree_scoring(spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(out) == len(pages)
    for p in pages:
        inner = p.html.split("<article>")[1].split("</article>")[0]
        inner = re.sub(r"<[a-zA-Z/][^>]*\Z", "", inner)
        parts = [" ".join(unescape(re.sub(r"</?(?:b|br)>", " ", s)).split())
                 for s in re.split(r"</?(?:p|h1|ul|li|div)[^>]*>", inner)]
        assert out[p.page_id].text == "\n\n".join(s for s in parts if s)
        assert out[p.page_id].n_chars == len(out[p.page_id].text) and out[p.page_id].url == p.url


LONG = "A sentence with commas, several of them, and enough words to be counted as text, really."


def test_boilerplate_goes():
    page = f"""<html><head><title>T</title><style>p{{}}</style></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
      <div class="cookie-notice"><p>{LONG} cookie</p></div>
      <div id="wrap"><div class="side-bar sidebar"><p>{LONG} side</p></div>
      <div class="post"><h1>Title &amp; all</h1><p>{LONG}<p>Second   one,&nbsp;<a href="x">linked</a> &lt;here&gt;
      <script>var a = "<p>no</p>";</script><form><p>{LONG} form</p></form><div class="ad">{LONG} ad</div>
      <ul><li>first<li>second</ul><table><tr><td>c1<td>c2</table><p hidden>{LONG}</p></div></div>
      <section id="comments"><p>{LONG} reader</p><p>{LONG} other reader</p></section>
      <aside>{LONG}</aside><footer><p>{LONG}</p></footer></body></html>"""
    assert main_text(page) == "\n\n".join(
        ["Title & all", LONG, "Second one, linked <here>", "first", "second", "c1", "c2"])


def test_article_is_kept_whole():
    page = f"<body><div><a>menu</a></div><article><header><h2>Head</h2></header><div><p>{LONG}</p><p>{LONG}</p></div><p>Short.</p></article></body>"
    assert main_text(page) == f"Head\n\n{LONG}\n\n{LONG}\n\nShort."


def test_siblings_are_kept():
    page = f"<body><div class=links><a href=1>{LONG}</a></div><h2>Head</h2><div><p>{LONG}</p></div><div><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert main_text(page) == f"Head\n\n{LONG}\n\n{LONG}\n\n{LONG}"


def test_names_do_not_hide_the_article():
    both = f"{LONG}\n\n{LONG}"
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    nav = f"<nav><a href=1>{LONG}</a></nav>"
    for page in (f'{nav}<div class="content-sidebar-wrap"><main>{body}</main></div>',
                 f'{nav}<div class="content right-sidebar">{body}</div>', f"<body><form>{nav}{body}</form></body>",
                 f'<div id="overlay"><article>{body}</article></div><div class="sidebar"><p>{LONG} side</p></div>',
                 f'<article><h2 class="x"></h2><div class="post-widget">{body}</div></article>',
                 f'<article>{body}</article><div class="sidebar">{body * 3}</div>',
                 f'<div>{body}</div><div class="related-posts">{body}</div>',
                 f'<article>{body}<div id="ad-1">{body}</div><div id="newsletter">{body}</div></article>',
                 f'<article>{body}<div class="ad">{body}</div><div class="promo-box">{body}</div></article>'):
        assert main_text(page) == both, page
    page = f"""<article><h2 id="sharing-your-data">Head</h2><section id="social-impact">{body}</section>
      <section id="menu-options"><p>{LONG}</p></section><h2 id="notice">End</h2><div class="ad">{LONG}</div>
      <p>{LONG}<span class="share">x</span></p></article><section id="comments"><article class="comment">{body * 9}</article></section>"""
    assert main_text(page) == f"Head\n\n{both}\n\n{LONG}\n\nEnd\n\n{LONG}"


def test_pages_of_boilerplate_alone_are_empty():
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    for page in (f'<div class="cookie-notice">{body}</div>', f'<section id="comments">{body}</section>',
                 f"<body><form>{body}</form></body>", f'<div class="comments">{body}</div>', f"<nav>{body}</nav>",
                 f'<div class="sidebar">{body}</div>', f'<article class="comment">{body}</article>',
                 f'<div role="navigation">{body}</div>'):
        assert main_text(page) == "", page


def test_of_two_articles_the_better_one():
    first, second = f"<p>{LONG} one</p>", f"<p>{LONG} two</p><p>{LONG} three</p>"
    assert main_text(f"<article>{first}</article><article>{second}</article>") == f"{LONG} two\n\n{LONG} three"
    assert main_text(f"<article>{first}</article><article>{first}</article>") == f"{LONG} one"


def test_odd_inputs():
    assert main_text(None) == main_text("") == main_text("<div></div>") == main_text("<!-- x") == ""
    assert main_text("just text &am &#x41;&#0;") == "just text &am A�"
    assert main_text(f"<article><p>{LONG}<b>cut <i") == f"{LONG}cut"
    deep = main_text("<div>" * 20000 + LONG + "</div>" * 20000)
    assert deep == LONG
    assert main_text("<div>x" * 3000).startswith("x")
    assert main_text("</p></div>" * 5000 + LONG) == LONG
    assert main_text('<a href="' * 2000) is not None


def test_frame_keeps_columns_nulls_and_repeats(spark):
    d = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (None, f"<p>{LONG}</p>", None)], "page_id long, html string, url string")
    out = html_text.extract(d).collect()
    assert [r.text for r in out] == ["", "", LONG] and out[0].asDict().keys() == {"page_id", "html", "url", "text"}
    assert html_text.extract(d.limit(0)).collect() == []
