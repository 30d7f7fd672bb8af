"""Main texts of pages whose article is known."""

import random
import re
import time

import pytest

from gleanery.llm.html_density import extract, main_texts

TEXT = "<h1>A title</h1><p>First &amp; <b>bo</b>ld  para,\n with text<br>after a break.</p><p>Second&nbsp;one, 1 &lt; 2.<ul><li>x<li>y</ul>"
MAIN = "A title\nFirst & bold para, with text after a break.\nSecond one, 1 < 2.\nx\ny"
NOISE = [
    "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></ul></nav>",
    "<header><h2>The site</h2><p>A slogan that is rather long, so that it is dense.</p></header>",
    '<div class="header"><h1>Site</h1></div>',
    "<aside><p>Also read this long text that somebody else has written.</p></aside>",
    '<div class="sidebar-left"><p>Popular: a list of things that many people read.</p></div>',
    "<div class='cookie-notice'>We use cookies to do things that you do not need to know.</div>",
    '<div id="ad-3">Buy now! <p>It is cheap.</p></div>',
    "<form><label>Name</label><input name=n><textarea>write <p>here</textarea><button>Go</button></form>",
    "<script>document.write('<p>no</p>')</script><style>p{}</style><!-- <p>no</p> -->",
    '<section id="comments"><p>I do not agree at all, and my comment is longer than all of what you wrote above it.</p></section>',
    "<footer>&copy; somebody, some place, some year</footer>",
]


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main class='with-sidebar'>%s</main>", "<div class=content>%s</div>", "<div class='has-ads'><div>%s</div></div>"])
@pytest.mark.parametrize("noise", [*NOISE, "".join(NOISE)])
def test_only_the_article(wrap, noise):
    page = f"<!DOCTYPE html><html><head><title>t</title></head><body>{noise}{wrap % TEXT}{noise}</body></html>"
    assert extract(page) == MAIN


def test_inside_an_article():
    assert extract(f"<article><header>{TEXT}</header>{NOISE[6]}{NOISE[9]}<p>End.</article>") == MAIN + "\nEnd."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<p></p>", ""),
        ("just text & <b>no</b> tags &lt; 5 <3", "just text & no tags < 5 <3"),
        ("<article><p>a<p>b <i", "a\nb"),
        ("<article><p>a &copy b &am", "a © b &am"),
        ("<article><p>a</p><script>x", "a"),
        ("<article><p title='a > b'>c</p>", "c"),
        ("<ARTICLE><P>A</P></ARTICLE>", "A"),
    ],
)
def test_odd_pages(page, text):
    assert extract(page) == text


@pytest.mark.parametrize("part", ["<div>", "<p a='", '<a "', "<!--", "<", "</div>", "<li>", "<td>", "&", "x "])
def test_long_pages_take_linear_time(part):
    started = time.process_time()
    extract(part * 100_000)
    assert time.process_time() - started < 10


def test_rows(spark):
    rows = [(1, "u", TEXT, "x"), (1, "u", TEXT, "x"), (None, None, None, None), (2, "v", f"<body>{NOISE[0]}<div>{TEXT}", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted((tuple(r) for r in main_texts(df).collect()), key=str)
    assert found == sorted([(1, "u", MAIN, len(MAIN))] * 2 + [(None, None, "", 0), (2, "v", MAIN, len(MAIN))], key=str)
    assert main_texts(df.limit(0)).collect() == []


def test_given_pages(spark):
    """Pages of the test tables mark their article, which gives another way to the same text."""
    import html as h

    path = "/root/testdata/sf0.001/pages.parquet"
    pages = spark.read.parquet(path)
    found = {r.page_id: r.text for r in main_texts(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"<[^>]*$", "", r.html[r.html.index("<article>") + 9 :].partition("</article>")[0])
        blocks = [re.sub("<[^>]+>", "", b) for b in re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))]
        blocks = [" ".join(h.unescape(b).split()) for b in blocks]
        assert found[r.page_id] == "\n".join(b for b in blocks if b)


STORY = [f"The {w} paragraph of this story tells at some length what happened on that day, and who saw it, and why." for w in ("first", "second", "third", "fourth")]
PARAS = "".join(f"<p>{p}</p>" for p in STORY)
CARDS = "".join(f"<article><h3><a href=/{i}>Another story {i}</a></h3><p>Read it now.</p></article>" for i in range(6))


@pytest.mark.parametrize("body", [f"<div class=story>{PARAS}</div>{CARDS}", f"{CARDS}<div class=story>{PARAS}</div>", f"<main>{CARDS}<div>{PARAS}</div></main>"])
def test_dense_text_wins_over_marked_cards(body):
    assert extract(f"<html><body>{NOISE[0]}{body}{NOISE[-1]}</body></html>") == "\n".join(STORY)


@pytest.mark.parametrize("wrap", ["%s", "<div>%s</div>"])
def test_a_text_in_several_articles(wrap):
    parts = [f"<article><h2>Part</h2>{PARAS}</article>"] * 3
    page = f"<body>{NOISE[0]}{wrap % f'<main><h1>Title</h1>{"".join(parts)}</main>'}{NOISE[-1]}"
    assert extract(page) == "\n".join(["Title", *["Part", *STORY] * 3])


@pytest.mark.parametrize("text", ["plain text that stands in its article without a tag", "one line<br>another line<br>a third line"])
def test_own_text_counts(text):
    assert extract(f"<body><div><a href=/>Home</a></div><article>{text}</article>") == text.replace("<br>", " ")


@pytest.mark.parametrize("name", ["id='content-sidebar-wrap'", "class=layout-sidebar", "class='right-sidebar'", "class='share-page'"])
@pytest.mark.parametrize("inner", ["%s", "<div class=content>%s</div>", "<div class='page-comments'><div>%s</div></div>"])
def test_a_layout_that_names_surroundings_keeps_its_text(name, inner):
    page = f"<body>{NOISE[0]}<div {name}>{NOISE[4]}{inner % PARAS}{NOISE[6]}{NOISE[9]}</div>{NOISE[5]}{NOISE[-1]}"
    assert extract(page) == "\n".join(STORY)


def test_a_layout_beside_longer_comments():
    comments = "".join(f"<div class=comment>{PARAS.replace('story', f'comment {i}')}</div>" for i in range(9))
    page = f"<body><div class=layout-sidebar><div>{PARAS}</div></div><section id=comments>{comments}</section>"
    assert extract(page) == "\n".join(STORY)


LONG = "These words stand in a long paragraph of the story, with commas, and go on for a while so that it is dense. "


@pytest.mark.parametrize(
    "page,text",
    [
        # all of an article, however thin its other parts are
        (f"<article><h1>T</h1><p>Intro.</p><div><p>{LONG * 3}</p><p>{LONG * 4}</p></div><p>End.</p></article>", f"T\nIntro.\n{LONG * 3}\n{LONG * 4}\nEnd."),
        (f"<article><section><p>{LONG * 5}</p></section><section><h2>B</h2><p>Tiny.</p></section></article>", f"{LONG * 5}\nB\nTiny."),
        (f"<main><section><p>{LONG * 5}</p></section><section><h2>B</h2><p>Tiny.</p></section></main>", f"{LONG * 5}\nB\nTiny."),
        # headline and lead beside the text
        (f"<body><h1>Head</h1><p class=lead>Lead.</p><div class=body><p>{LONG * 3}</p><p>{LONG * 4}</p></div></body>", f"Head\nLead.\n{LONG * 3}\n{LONG * 4}"),
        (f"<body><div class=top><h1>Head</h1></div><div class=body><p>{LONG * 3}</p><p>{LONG * 4}</p></div></body>", f"Head\n{LONG * 3}\n{LONG * 4}"),
        # a site's name is no headline if the text has its own
        (f"<body><h1>Site</h1><p>Claim</p><div class=body><h1>Head</h1><p>{LONG * 3}</p><p>{LONG * 4}</p></div></body>", f"Head\n{LONG * 3}\n{LONG * 4}"),
        # a word of a class says what a paragraph is about
        (f'<article><p>{LONG * 3}</p><p class="search-results">{LONG}</p><p class="ad">Buy.</p></article>', f"{LONG * 3}\n{LONG}"),
        # reader comments by other names
        (f"<article><p>{LONG * 3}</p></article><section class=discussion><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></section>", LONG * 3),
        # cards beside a story
        (f"<main><article><a href=x>Card</a></article><div class=story><p>{LONG * 5}</p><p>{LONG * 4}</p></div><article><a href=y>Other card</a></article></main>", f"{LONG * 5}\n{LONG * 4}"),
    ],
)
def test_whole_articles(page, text):
    assert extract(page) == "\n".join(line.strip() for line in text.split("\n"))


def test_generated_pages(spark):
    """Articles of known text in many layouts, with surroundings that carry names."""
    r = random.Random(11)

    def words(n):
        return " ".join(r.choice(["river", "stone", "and", "light,", "over", "slow", "boats."]) for _ in range(n))

    for _ in range(150):
        title, parts, html = words(4), [], ""
        for _ in range(r.randint(2, 6)):
            kind, said = r.choice([("p", words(r.randint(30, 90))), ("p", words(r.randint(40, 120))), ("blockquote", words(30)), ("h2", words(3)), ("p", words(5))])
            parts.append(said)
            html += f"<{kind}>{said}</{kind}>"
        parts.append(words(80))
        html += f"<p>{parts[-1]}</p>"
        around = r.choice(["article", "main"])
        inner = f"<{around}><h1>{title}</h1>{html}</{around}>"
        if r.random() < 0.5:
            inner = f'<div class="layout-sidebar"><div class=wrap>{inner}</div></div>'
        links = "".join(f"<li><a href=/{i}>{words(2)}</a></li>" for i in range(r.randint(2, 9)))
        page = f"<html><body><nav><ul>{links}</ul></nav><header><h1>Site</h1></header>{inner}<aside><p>{words(40)}</p></aside>"
        page += f'<div class="comments"><p>{words(60)}</p></div><footer>{words(9)}</footer></body></html>'
        assert extract(page) == "\n".join([title, *parts])


def test_deep_nesting():
    deep = "<div>" * 20_000 + f"<p>{LONG}</p>" + "</div>" * 20_000
    assert extract(deep) == LONG.strip()


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "u", f"<p>{LONG}</p>", "x", 3), (2, None, None, "y", 4)], "page_id long, url string, html string, text string, n_chars int")
    assert sorted((r.page_id, r.text) for r in main_texts(rows).collect()) == [(1, LONG.strip()), (2, "")]
