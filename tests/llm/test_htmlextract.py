import html
import random
import re
import time

import pytest

from shopledger.llm import htmlextract
from shopledger.llm.htmlextract import main_text

SCHEMA = "page_id long, url string, html string, text string, n_chars string"


def article(page):
    """The article's blocks by pattern; the test pages mark it up plainly."""
    inside = re.search("<article>(.*)</article>", page, re.S)[1]
    inside = re.sub(r"</?(p|h1)\b[^>]*>", "\0", inside)
    inside = re.sub("<[^>]*>", "", inside.replace("<br>", " "))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in inside.split("\0")) if x)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_whole_pages(spark, folder):
    pages = spark.read.parquet(f"/root/testdata/{folder}/pages.parquet")
    want = {r.page_id: (r.url, article(r.html)) for r in pages.collect()}
    got = htmlextract.extract(pages).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(want)


def test_furniture_goes_and_short_blocks_stay():
    page = """<html><head><title>t</title></head><body class="no-sidebar"><header><h1>Site</h1></header>
    <div role="navigation"><a href=x>Home</a></div><div class="cookie-notice"><p>We use cookies on this site for long reasons.</p></div>
    <div id="story"><h2>A &lt;title&gt;</h2><p>First   long&nbsp;paragraph, with <b>bold</b>face and <a href=y>a link</a> in it, on and on.
    <p>Ok.<ul><li>one<li>two</ul><blockquote>said<br>so</blockquote><script>var x = "</p>";</script><form><p>Mail me</p></form></div>
    <aside>Other things to read, quite long as well, to be sure of it.</aside><section id="comments"><p>First! A reader's comment.</p></section>
    <footer>Copyright</footer>"""
    assert main_text(page) == "A <title>\nFirst long paragraph, with boldface and a link in it, on and on.\nOk.\none\ntwo\nsaid so"


def test_article_header_keeps_its_title():
    page = "<body><article><header><h1>Title</h1><p>by me</p></header><p>Body of the text.</p></article></body>"
    assert main_text(page) == "Title\nBody of the text."


def test_ratio_finds_the_region_without_semantic_elements():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(30))
    prose = "".join(f"<p>Paragraph {i} has a good many words in it, as prose has, again and again.</p>" for i in range(12))
    page = f"<body><table><tr><td><ul>{links}</ul></td><td><div>{prose}<p>End.</p></div></td></tr></table></body>"
    assert main_text(page) == "\n".join([*(f"Paragraph {i} has a good many words in it, as prose has, again and again." for i in range(12)), "End."])


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no markup"), (3, "u", "no markup"), (None, "v", "<p>a<p>b"), (4, "u", "<<<&amp;<p"),
            (5, "u", "<div>" * 3000 + "deep"), (6, "u", "<p>" + "long text " * 100000)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = {(r.page_id, r.url, r.text[:20]) for r in htmlextract.extract(frame).collect()}
    assert {(1, "u", ""), (2, None, ""), (3, "u", "no markup"), (None, "v", "a\nb"), (5, "u", "deep"), (6, "u", "long text long text ")} <= got
    assert htmlextract.extract(frame).count() == len(rows)
    assert htmlextract.extract(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("body", [12, 30, 120])
@pytest.mark.parametrize("element", ["div", "article"])
def test_lead_beside_the_body_stays(body, element):
    lead = [f"Lead {i} " + "says a good many words. " * 7 for i in range(3)]
    prose = [f"Paragraph {i} " + "has a good many words in it. " * 14 for i in range(body)]
    blocks = lambda texts: "".join(f"<p>{x}</p>" for x in texts)
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(20))
    page = f"<body><ul>{links}</ul><div><div><h1>A title</h1>{blocks(lead)}</div><{element}>{blocks(prose)}<p>End.</p></{element}></div><ul>{links}</ul></body>"
    assert main_text(page) == "\n".join(["A title", *(x.strip() for x in lead + prose), "End."])
    assert main_text(page.replace("<div><h1>", "<h1>").replace("</p></div><" + element, "</p><" + element)).startswith("A title\nLead 0")


def test_head_without_an_end_tag():
    prose = "<p>A paragraph with a good many words in it.</p><p>Another one.</p>"
    want = "A paragraph with a good many words in it.\nAnother one."
    for start in ("<head><title>t</title><meta charset=utf-8><body>", "<head><title>t</title><div>", "<head><style>p {}</style>"):
        assert main_text("<!doctype html><html>" + start + prose) == want
    assert main_text("<head><title>t</title>Plain <b>text</b>") == "Plain text"


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "widget-area main-text"])
def test_furniture_words_in_the_name_of_a_wrapper(name):
    prose = "".join(f"<p>Paragraph {i} has a good many words in it, as prose has.</p>" for i in range(9))
    want = "\n".join(f"Paragraph {i} has a good many words in it, as prose has." for i in range(9))
    side = "<div class=sidebar><p>Other things to read, this week.</p></div><p>x <span class=share>Share me</span>y</p>"
    comments = "<div id=comments>" + "".join(f"<article class=comment><p>Reader {i} says that this is a good text.</p></article>" for i in range(30)) + "</div>"
    assert main_text(f"<body><div class='{name}'>{prose}{side}</div><div class=footer>Copyright</div></body>") == want + "\nx\ny"
    assert main_text(f"<body><div class='{name}'><article>{prose}</article>{side[:60]}</div>{comments}</body>").startswith(want)
    assert "Reader" not in main_text(f"<body><div class='{name}'><article>{prose}</article></div>{comments}</body>")


PROSE = "".join(f"<p>Paragraph {i} has a good many words in it, as prose has, again and again.</p>" for i in range(8))
TEXT = "\n".join(f"Paragraph {i} has a good many words in it, as prose has, again and again." for i in range(8))


def test_article_inside_a_form():
    menu = "<div class=menu><a href=/a>A</a><a href=/b>B</a></div>"
    assert main_text(f"<body><form action=x>{menu}<article>{PROSE}</article><input name=q></form></body>") == TEXT
    assert main_text(f"<body><form action=x><div id=content>{PROSE}</div></form><form><p>Mail me news</p></form></body>") == TEXT


def test_open_furniture_ends_at_the_article():
    links = "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(5))
    assert main_text(f"<body><nav><ul>{links}</ul><article>{PROSE}</article></body>") == TEXT
    assert main_text(f"<body><article>{PROSE}</article><aside><article><p>Another article, teased here.</p></article></aside></body>") == TEXT


def test_comments_under_a_plain_heading():
    comments = "<section><h2>3 Comments</h2><p>I liked it, and a lot of it, too, as I always do with such texts.</p></section>"
    assert main_text(f"<body><div id=c>{PROSE}</div>{comments}</body>") == TEXT
    assert main_text(f"<body><article><h2>Comments</h2>{PROSE}</article></body>") == "Comments\n" + TEXT


def test_title_in_a_named_header_of_the_article():
    page = f"<body><div class='post-header'><h1>Title</h1><span>by me</span></div><div class=post-body>{PROSE}</div></body>"
    assert main_text(page) == "Title\n" + TEXT


def test_end_tags_of_deep_elements():
    deep = "<div>" * 600
    assert main_text(f"<article><p>One long line of text.</p>{deep}x{'</div>' * 600}<p>Two long lines of text.</p></article>").endswith("x\nTwo long lines of text.")


@pytest.mark.parametrize("mark", ["<a ", "<!--", "<![", "<!", "&#", "&#x", "</", "<?", '<a x="', "<a x='", "<a '>", '<a "b>', "<", "&", "<script>",
                                  "<title>", "<div>", "<p>x", "<td>x", "</p>", "<a x=y", "&#1", "<div>x", "</div", "<div class=ad>x",
                                  "<form>x", "<pre><div></pre>", "<main>x", "<blockquote>x", "<section><h2>Comments</h2>"])
@pytest.mark.parametrize("end", ["", ">", "-->", '">', "</article>"])
def test_a_megabyte_of_anything_ends_soon(mark, end):
    started = time.monotonic()
    main_text(f"<article><p>Text</p>{mark * (1_000_000 // len(mark))}{end}")
    assert time.monotonic() - started < 8


def test_declarations_and_references_never_raise():
    assert main_text("<article><p>One <![foo[x]]>two &#" + "9" * 6000 + "; three &#0000000065; &#x" + "0" * 50 + "42;</p></article>") == "One two � three A B"
    rng = random.Random(11)
    signs = ["<", ">", "!", "[", "]", "--", "&#", "&", ";", "/", "a", "p", "div", "script", "<p>", "</p>", "'", '"', "=", " ", "9" * 20, "x", "\0", "?", "퟿", "<!", "<!["]
    for _ in range(20000):
        assert isinstance(main_text("".join(rng.choice(signs) for _ in range(rng.randrange(25)))), str)
