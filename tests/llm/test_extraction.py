import re

import pytest

from flowmart.llm import extraction

PROSE = "This is a long block of prose that the page is all about, with many words and no links at all in it."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"), ("<script>var x='</p><p>no';</script><p>yes", "yes"),
    (f"<nav><a href=/>Home</a></nav><article><h1>T &lt;1&gt;</h1><p>{PROSE}<p>Short.<br>End&nbsp;here.</article><footer>f</footer>", f"T <1>\n\n{PROSE}\n\nShort. End here."),
    (f"<div class='sidebar widget'>{PROSE}</div><div id='main'><h2>H</h2><p>{PROSE}</p><p>x</p></div><div class=comments><p>{PROSE}</p></div>", f"H\n\n{PROSE}\n\nx"),
    (f"<article><header><h1>Head</h1></header><p>{PROSE}</p><aside>related</aside><form><input>go</form></article>", f"Head\n\n{PROSE}"),
    (f"<main><ul><li>one<li>two</ul><table><tr><td>{PROSE}<td>b</table></main>", f"one\n\ntwo\n\n{PROSE}\n\nb"),
    (f"<article><div class='cookie-notice'>We use cookies</div><p>a <b>bold</b>, <i>it</i>alic word. {PROSE}</p></article>", f"a bold, italic word. {PROSE}"),
    (f"<header>site</header><p>{PROSE}</p><!-- <p>hidden</p> --><style>p{{}}</style><p hidden>no</p>", PROSE),
    ("<article><p>" + "long text " * 200_000 + "</article>", ("long text " * 200_000).strip()),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<nav>only a menu</nav>", ""), ("<p title='a>b'>c</p", "c"),
])
def test_main_text(page, text):
    assert extraction.main_text(page) == text


def test_blocks_of_all_driver_pages(spark):
    """Every block of the article, and nothing else, by a plain cut at block tags."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    own = {r.page_id: r.html for r in pages.collect()}
    for r in extraction.extract(pages).collect():
        article = own[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>a", 3), (1, "u", "<p>a", 3), (None, None, None, 4)], "page_id long, url string, html string, text int")
    got = extraction.extract(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "a", 1), ("1", "a", 1), ("None", "", 0)]
    assert extraction.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize("around,each", [("<div class=page>{}</div>", "section"), ("<div>{}</div>", "p"), ("<main>{}</main>", "article"),
                                         ("<div class='layout sidebar'><main>{}</main></div>", "article"), ("<main>{}</main>", "section")])
def test_one_very_long_paragraph_drops_no_other(around, each):
    blocks = [f"Part {i}. An ordinary paragraph, long enough to be read as prose." for i in range(30)]
    blocks[15] = "long text " * 4000
    blocks[29] = "The end."
    page = "<nav><a href=/>Home</a></nav>" + around.format("".join(f"<{each}><p>{b}</p></{each}>" if each != "p" else f"<p>{b}</p>" for b in blocks)) + "<footer>f</footer>"
    assert extraction.main_text(page) == "\n\n".join(b.strip() for b in blocks)


def test_plain_blocks_beside_a_very_long_one_stay():
    blocks = [f"Part {i}. An ordinary paragraph, long enough to be read as prose by anyone who comes along, and a little more." for i in range(11)]
    blocks[0] = "long text " * 4000
    assert extraction.main_text("".join(f"<div><p>{b}</p></div>" for b in blocks)) == "\n\n".join(b.strip() for b in blocks)


@pytest.mark.parametrize("page,text", [
    (f"<div class='has-sidebar'><article><p>{PROSE}</article></div>", PROSE),
    (f"<div id='content-sidebar-wrap'><article><p>{PROSE}</article><div class='sidebar'><p>{PROSE}x</div></div>", PROSE),
    (f"<body class='content-sidebar'><article><p>{PROSE}</article><aside>a</aside>", PROSE),
    (f"<article><div class='share-story'><p>{PROSE}</div></article>", PROSE),
    (f"<article><div class='related-posts-on'><p>{PROSE}</div><div class='related-posts'><p>{PROSE}</div></article>", PROSE),
    (f"<div class='sidebar'><article><p>{PROSE}</article></div><nav>m</nav>", PROSE),
    (f"<article><p>{PROSE}</article><div class='sidebar'><article><p>Teaser. {PROSE}</article></div>", PROSE),
    (f"<article><p>{PROSE}</article><div class='comments'><article><p>I think. {PROSE}</article></div>", PROSE),
    (f"<div class='comment-list'><article><p>{PROSE}</article></div>", ""),
    (f"<article><div class='article-sidebar'><p>{PROSE}</div><p>{PROSE}</article>", PROSE),
    (f"<div class='no-sidebar page'><p>{PROSE}</p></div><div class='cookie-notice'>{PROSE}</div>", PROSE),
])
def test_names_of_layout_do_not_drop_the_article(page, text):
    assert extraction.main_text(page) == text
