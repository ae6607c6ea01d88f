from millrace.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
<header class="site-header"><nav><ul><li><a href="/">Home</a></li><li><a href="/x">About us</a></li></ul></nav></header>
<div class="cookie-banner">We use cookies. <button>OK</button></div>
<main><article><h1>A &amp; B</h1><p>First   paragraph with <b>bold</b> and <a href="#">a link</a> &eacute;.</p>
<div class="advert">Buy now</div><p>Second one<br>goes on.</p><!-- <p>hidden</p> --><form><input value="q"><label>Name</label></form></article></main>
<aside class="sidebar"><p>Related things to read on some other day and place.</p></aside>
<section id="comments"><p>Reader: what a long and thoughtful comment this is, with many words in it.</p></section>
<footer><p>Copyright 2024 by nobody at all</p></footer></body></html>"""


def test_article_alone():
    assert html.main_text(PAGE) == "A & B\nFirst paragraph with bold and a link é.\nSecond one goes on."


def test_odd_pages(spark, clash):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>"), (4, "u", "<article><p>a &lt;b&gt; &#8364; &nbsp;c</p>"), (4, "u", "no markup"), (None, "u", PAGE), (5, "u", "<" * 2000), (6, "u", "<article>" + "<div>" * 3000 + "deep words" + "</div>" * 3000)]
    got = html.extract(clash(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == "" and by[6]["text"] == "deep words"
    assert {r["text"] for r in got if r["page_id"] == 4} >= {"a <b> € c"}
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_empty_table(spark):
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_the_tree_fits_its_table():
    import numpy as np

    table = np.array([line.split() for line in html.LABELLED.split("\n") if line], float)
    tree = html.default_tree()
    assert np.mean([tree(r[:-1]) == r[-1] for r in table]) > 0.95


BODY = "<article><p>The first words of the article stand here.</p>%s<p>And the last ones of it stand here.</p></article>"
BOTH = "The first words of the article stand here.\nAnd the last ones of it stand here."


def test_markup_in_raw_elements_ends_nothing():
    for inside in (
        "<script>for(i=0;i<n;i++){f()}</script>", "<SCRIPT type='x'>if (a<b) { s = \"<!--\" }</Script >", "<script>s = '<div class=\"' + c</script>", "<style>a:before{content:'<!--'}</style>",
        "<textarea>a<b \" </textarea>", "<noscript><img alt='\"></noscript>", "<iframe><!-- </iframe>", "<template><script>a<b</script></template>", "<script>'</scripts>'</script>",
        "<svg><title>x</svg>", "<script src='x'></script>", "<script>for(var i=0;i<n;i++){a()}</script>",
    ):
        assert html.main_text("<html><body>" + BODY % inside + "</body></html>") == BOTH, inside
        assert html.main_text("<html><head>" + inside * ("svg" not in inside) + "</head><body>" + BODY % "" + "</body></html>") == BOTH, inside
    assert html.main_text(BODY % "<script>never ended <p>no text of the page</p>") == "The first words of the article stand here."


def test_a_head_without_an_end():
    for head in ("<head>", "<head><title>A title of some words</title>", "<HEAD><meta charset=utf-8><script>a<b</script><template><p>None of it at all, of course.</p></template>"):
        for body in ("<body>", "", "</html>", "<!-- c -->"):
            assert html.main_text(f"<!DOCTYPE html><html>{head}\n{body}" + BODY % "") == BOTH, (head, body)
    assert [b[0] for b in html.blocks("<head><title>T</title>words of a page")] == ["words of a page"]
    assert [b[0] for b in html.blocks("<head><title>T</title>words <b>of</b> a page")] == ["words of a page"]


def test_wrappers_of_any_name():
    for name in ("page-header-wrap", "legal", "siteHeader", "banner", "content notice", "widget", "search"):
        assert html.main_text(f'<body><div class="{name}">' + BODY % "" + "</div></body>") == BOTH, name
        told = ["It is told at some length what the first of all things has been. " * 3, "And at some length, too, what has become of all the things behind it. " * 3]
        plain, both = "".join(f"<p>{t}</p>" for t in told), "\n".join(t.strip() for t in told)
        assert html.main_text(f'<body><div id="{name}"><h1>First of all</h1>{plain}</div></body>') == "First of all\n" + both, name
        assert html.main_text(f"<body><div class={name.split()[0]}>{plain}</div></body>") == both, name
    assert html.main_text('<body><form id="aspnetForm"><div class="sidebar-left">' + BODY % "" + "</div></form></body>") == BOTH
    assert html.main_text("<body>" + BODY % '<div class="legal">Some rights reserved by none.</div><div class="comments"><p>A reader says some words.</p></div>' + "</body>") == BOTH
    assert html.main_text("<body>" + BODY % "" + '<section class="comments"><article class="comment"><p>' + "A reader has to say a lot of words. " * 9 + "</p></article></section></body>") == BOTH
    assert html.main_text('<body><div class="page-header">The name of the site</div>' + BODY % "" + '<form action="/"><p>Write your name here, please.</p></form></body>') == BOTH
    assert html.main_text("<body>" + BODY % "<header><p>A header of the article itself.</p></header>" + "</body>").count("\n") == 2


def test_formulas_stay():
    got = html.main_text("<article><p>Of <math><mi>a</mi><mo>+</mo><mn>1</mn><annotation>a+1</annotation></math> it is told here.</p></article>")
    assert got == "Of a+1 it is told here."


def test_broken_and_long_pages_take_linear_time():
    import time

    for part in ('<a "', "<a b='", '<p c="', "<!--", "<!", "<?", "<", "</", "</p", "<b>", "<div class=comments>", "<p><b>", "</i>", "<script>", "<a href=x>y", "&amp", "<li><ul>", '<p title="a>b" \'>x</p>'):
        took = []
        for n in (4_000, 64_000):
            began = time.process_time()
            html.main_text("<article><p>some words</p>" + part * n)
            took.append(time.process_time() - began)
        assert took[1] < 40 * took[0] + 0.5, (part, took)
    assert html.main_text(BODY % '<p title="a > b" class=x>A title holds a mark.</p>').split("\n")[1] == "A title holds a mark."
    words = " ".join(f"w{i}" for i in range(200_000))
    assert html.main_text(f"<article><p>{words}</p></article>") == words


def test_hidden_is_an_attribute_of_its_own():
    for shown in ('title="The hidden truth of trees"', 'class="overflow hidden p4"', 'data-x=hidden', "alt='a display : none'", 'hidden-x="1"', 'aria-hidden="false"'):
        assert html.main_text(f"<body><div {shown}>" + BODY % "" + "</div></body>") == BOTH, shown
    for gone in ("hidden", "HIDDEN=''", "aria-hidden=true", 'style="color:red; display: none"'):
        assert html.main_text("<body>" + BODY % f"<div {gone}><p>Words that nobody gets to see here.</p></div>" + "</body>") == BOTH, gone


def test_short_blocks_of_pages_without_an_article_element():
    assert html.main_text("<body><h1>Title here</h1><p>Short first paragraph.</p><p>Second short one.</p>") == "Title here\nShort first paragraph.\nSecond short one."
    assert html.main_text("<div class=content><p>Three words only.</p><p>And then a paragraph that has just about a dozen words in it.</p></div>").count("\n") == 1
    assert html.main_text("just a page of plain text\n without any markup") == "just a page of plain text without any markup"
    assert html.main_text("<body><ul class=nav><li><a href=/>Home</a></ul><p>- Who is it?</p><p>- Me.</p><ul><li>one thing</li><li>another</li></ul><div id=footer><p>By nobody.</p></div>") == "- Who is it?\n- Me.\none thing\nanother"


def test_names_of_headings_and_paragraphs_say_nothing():
    for inside in (
        '<section id="discussion"><p>Of which something is said at this place.</p></section>', '<h2 id="related-work">Other work that is related to it</h2>', '<h2 id="Advertising_in_1920">Advertising in those years, as it was</h2>',
        '<p class="social">A social paragraph of the article stands here.</p>', '<section id="sharing-of-spoils"><h3 class="share">How it was shared out</h3></section>', '<ul><li id="comment-on-it">A thing that is listed</li></ul>',
    ):
        got = html.main_text("<body>" + BODY % inside + "</body>").split("\n")
        assert len(got) == 3 and [got[0], got[2]] == BOTH.split("\n"), inside
    for inside in ('<section id="comments"><p>A reader says a thing of his own here.</p></section>', '<div class="share">Share it with all of them now</div>', '<div id="related"><p>Other things to be read here.</p></div>'):
        assert html.main_text("<body>" + BODY % inside + "</body>") == BOTH, inside


def test_sources_of_an_article_stay():
    links = "".join(f'<li><a href="/{i}">A source of number {i}</a></li>' for i in range(4))
    end = BODY.replace("</article>", f"<h2>Sources</h2><ol>{links}</ol></article>") % ""
    assert html.main_text(f"<body>{end}</body>") == BOTH + "\nSources\n" + "\n".join(f"A source of number {i}" for i in range(4))
    assert html.main_text(f'<body><nav><h2>Menu</h2><ul>{links}</ul></nav>{BODY % ""}<div><ul>{links}</ul></div></body>') == BOTH


def test_generated_layouts_give_their_own_text():
    import random

    rng = random.Random(11)
    sentence = lambda: " ".join(rng.choice("the tree of a long old river stands where men went by".split()) for _ in range(rng.randint(4, 30))).capitalize() + "."
    wraps = ["<article>{}</article>", "<main>{}</main>", '<div class="post">{}</div>', '<div id="page"><div class="content hidden-xs">{}</div></div>', "<section>{}</section>", "{}", '<main><div class="entry">{}</div></main>', "<table><tr><td>{}</td></tr></table>", '<div title="nav menu">{}</div>', '<article id="sharing">{}</article>']
    around = ['<div class="navbar"><a href=/>Home</a> <a href=/b>Blog</a></div>', '<ul class="menu"><li><a href=/>Home</a><li><a href=/c>All posts</a></ul>', "<nav><a href=/>Home</a></nav>"]
    below = ['<footer><p>Nobody, 1999</p></footer>', '<div class="footer">Nobody, 1999</div>', '<div id="comments"><p>A reader was here.</p></div>', '<aside><p>Read this as well, it is new.</p></aside>']
    for wrap in wraps:
        title, told = sentence(), [sentence() for _ in range(rng.randint(2, 7))]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{t}</p>" if i % 3 else f"<h2>{t}</h2>" for i, t in enumerate(told, 1))
        page = f"<!DOCTYPE html><html><head><title>x</title></head><body>{rng.choice(around)}{wrap.format(body)}{rng.choice(below)}</body></html>"
        assert html.main_text(page) == "\n".join([title, *told]), page
