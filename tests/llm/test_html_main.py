from __future__ import annotations

import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from panelforge.llm import html_main
from panelforge.llm.html_main import Model, extract, labelled_pages, parse, train

MODEL = train(labelled_pages())
PAGE = "<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a='</p>';</script></head><body>%s</body></html>"
LONG = "This is a sentence of the article that says something. " * 4


def main_text(body):
    return MODEL.blocks(PAGE % body)


def test_messages_give_exact_marginals():
    """Against the sum over all state assignments of small trees."""
    for body in ("<div class='ad'>Buy now</div><article><h1>Title here</h1><p>Some text.</p></article>", "<p>One</p><ul><li><a href='x'>a</a><li>b</ul>"):
        page = parse(body)
        n, total, content = len(page.parent), 0.0, [0.0] * len(page.parent)
        for states in itertools.product(range(3), repeat=n):
            p = MODEL.root[states[0]]
            for i in range(1, n):
                text = page.text[i] is not None
                p *= MODEL.edge(None if text else page.features[i])[states[page.parent[i]]][states[i]]
                if text:
                    p *= MODEL.unary(page, i)[states[i]] ** (1 / sum(page.group[j] == page.group[i] and page.text[j] is not None for j in range(n)))
            total += p
            for i in range(n):
                content[i] += p * (states[i] == 1)
        assert all(math.isclose(a, b / total, rel_tol=1e-6, abs_tol=1e-9) for a, b in zip(MODEL.marginals(page), content, strict=True))


def test_held_out_layouts():
    right = wrong = missed = 0
    for page in labelled_pages(200, seed=77):
        tree = parse(page)
        want = [t for t, y in zip(tree.text, tree.label, strict=True) if t is not None and y == 1]
        got = MODEL.blocks(re.sub(r' data-y="\d"', "", page))
        right, wrong, missed = right + len(set(want) & set(got)), wrong + len(set(got) - set(want)), missed + len(set(want) - set(got))
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


BOILER = [
    '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>', '<header><h1>Site</h1><p>Slogan here</p></header>', "<footer>&copy; 2020 Site. All rights reserved.</footer>", f'<div class="ad">{LONG}</div>',
    f'<aside class="sidebar"><h3>More</h3><p>{LONG}</p></aside>', f'<div id="cookie-notice"><p>{LONG}</p><button>OK</button></div>', '<form><label>Name</label><input name="a"><button>Send</button></form>',
    f'<section class="comments"><h2>Comments</h2><div class="comment"><p>{LONG}</p></div></section>', f'<div id="comments"><article class="comment"><p>{LONG}</p></article></div>', f"<script>document.write('{LONG}')</script>", f"<style>{LONG}</style>", f"<!-- {LONG} -->", f"<noscript>{LONG}</noscript>",
]


@pytest.mark.parametrize("part", BOILER)
def test_parts_that_are_not_the_article(part):
    article = f"<article><h1>The title</h1><p>{LONG}</p><p>Short end.</p></article>"
    want = ["The title", LONG.strip(), "Short end."]
    assert main_text(part + article) == want
    assert main_text(article + part) == want


def test_text_rules():
    assert main_text(f"<article><h1>A &amp; B&nbsp;&lt;c&gt;</h1><p>x\n\t y<br>z &#233; &quot;q&quot; {LONG}<p>open <b>bold <i>both</b> more.</i> {LONG}</article>") == ["A & B <c>", 'x y z é "q" ' + LONG.strip(), "open bold both more. " + LONG.strip()]
    assert main_text(f"<article><p><b>{LONG}<br></article><footer>no</footer>") == [LONG.strip()]
    assert main_text(f"<article><p>1 < 2 and {LONG}</p></article>") == ["1 < 2 and " + LONG.strip()]
    assert main_text(f"<article><p>All rights reserved.</p><p>{LONG}</p></article>") == ["All rights reserved.", LONG.strip()]
    assert main_text("<article><p>" + LONG * 500 + "</p></article>") == [(LONG * 500).strip()]
    assert MODEL.blocks(f"<article><p>{LONG}</p><p>cut he") == [LONG.strip(), "cut he"]
    assert MODEL.blocks(f"<article><p>{LONG}</p><p>cut <a href=") == [LONG.strip(), "cut"]


@pytest.mark.parametrize("source", [None, "", "<", "<<<>>>", "</p></div>", "<!--", "<script>", "<title>x", "plain", "<p", "<a href='", "<body><body><head><p>", "<table><tr><td><tr><td>", "&", "&#xfffffff;", "<p>" * 3000])
def test_broken_markup(source):
    assert isinstance(MODEL.blocks(source), list)


def test_frame(spark):
    rows = [(1, "u", PAGE % f"<article><p>{LONG}</p></article>"), (2, None, None), (None, "u", ""), (1, "u", PAGE % f"<article><p>{LONG}</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"row": F.lit(1), "blocks": F.lit(2)})
    got = sorted(((r.row.page_id, r.blocks) for r in extract(df, [F.col("page_id")], model=MODEL).collect()), key=repr)
    assert got == sorted([(1, [LONG.strip()]), (1, [LONG.strip()]), (2, []), (None, [])], key=repr)
    assert extract(df.limit(0), [F.col("page_id")], model=MODEL).collect() == []


def test_model_is_data():
    assert isinstance(train([]), Model)


@pytest.mark.parametrize("tag", ["<a href=/x title=O'Neil>x</a>", '<img alt="5" tall">', "<p title=it's>Don't stop here.</p>", "<a b = 'x>y' c=d\" e>x</a>", "<é>"])
def test_stray_quotes_lose_no_text(tag):
    """A quote opens a value only right after "=", and only a page without a further ">" ends inside a tag."""
    got = main_text(f"{tag}<article><p class=a>{LONG}</p><p>It's \"all\" here.</p></article>")
    assert got[-2:] == [LONG.strip(), 'It\'s "all" here.']
    assert main_text(f'<article><p>{LONG}</p></article><a href="/x>y</a>') == [LONG.strip()]
    assert MODEL.blocks(f'<a href="/x>y</a><article><p>{LONG}</p></article>')[-1] == LONG.strip()
    assert [t for t in parse("<p title=it's>Don't stop here.</p>").text if t] == ["Don't stop here."]


@pytest.mark.parametrize("attr", ['data-year="2020"', "data-youtube-id=x", "data-y", 'data-y="b"', 'data-y="7"', 'id="a" data-id="comments" id="sidebar" xclass=ad', "aria-hidden='false'"])
def test_attributes_are_whole_names(attr):
    assert main_text(f"<article {attr}><p>{LONG}</p></article>") == [LONG.strip()]
    want = {"id": "a"} if attr.startswith("id") else {}
    assert {k: v for k, v in html_main._attributes(" " + attr).items() if k != "data-y"} == want


@pytest.mark.parametrize("attrs", ['id="comments" width="5"', 'id="comments" data-id="7"', "width=5 ID = 'comments' id=main"])
def test_first_value_of_an_attribute_stays(attrs):
    assert "mark=talk" in parse(f"<div {attrs}>x</div>").features[1]


def test_labels_are_read_in_training_only():
    page = "<div data-y=1><p data-y=0>a</p><p data-year=0>b</p></div>"
    assert parse(page).label == [None, 1, 0, 0, 1, 1] and set(parse(page, labelled=False).label) == {None}


S = "A sentence that says something about it."


@pytest.mark.parametrize(
    ("body", "want"),
    [
        (f"<article><div class='warning'><p>{S}</p></div><p>{S} Twice.</p></article>", [S, S + " Twice."]),
        (f"<article><div class='cookie-notice'><p>{S}</p></div><p>{S} Twice.</p></article>", [S + " Twice."]),
        (f"<article><section class='related-work'><p>{S}</p><p>{LONG}</p></section></article>", [S, LONG.strip()]),
        ("<article><div>One</div><div>Two words</div></article>", ["One", "Two words"]),
        ("<article><p>One</p></article>", ["One"]),
        (f"<article><p>{S}</p><ul><li><a href=a>First link</a><li><a href=b>Second link</a><li><a href=c>Third</a></ul></article>", [S, "First link", "Second link", "Third"]),
        (f"<article><p><a href=a>Only a link</a></p><p>{S}</p></article>", ["Only a link", S]),
        (f"<article><p>AT&<b>amp;</b>T and {S}</p></article>", ["AT&amp;T and " + S]),
        (f"<article><p>AT&amp;T &am<i>p;</i> {S}</p></article>", ["AT&T &amp; " + S]),
        (f"<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be. {S}</p></article>", ["Let x=1 be. " + S]),
        (f"<!--><article><p>{S}</p></article>", [S]),
        (f"<!---><article><p>{S}</p><!-- a > b --!><p>{S}</p><!----><p>End.</p></article>", [S, S, "End."]),
        (f"<nav class='menu'><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav><article><p class='byline'>By someone</p><p>{S}</p></article><footer>Imprint</footer>", ["By someone", S]),
        (f"<article><p>{S}</p><div class='ad'><p>{LONG}</p></div><aside class='sidebar'><p>{LONG}</p></aside><section id='comments'><p>{LONG}</p></section><p>{S}</p></article>", [S, S]),
    ],
)
def test_an_article_keeps_all_of_its_text(body, want):
    assert main_text(body) == want
    assert main_text(f"<div class='wrapper'>{body}</div>") == want


def test_an_article_of_links_alone():
    assert main_text("<nav><a href=x>Home</a></nav><article><ul><li><a href=a>First</a></li><li><a href=b>Second</a></li></ul></article>") == ["First", "Second"]


def other_sites(n, seed):
    """Another generator than the model's: its own words, tags, nesting and names; blocks of the main text beside each page."""
    rng = random.Random(seed)
    noun = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))
    say = lambda a, z: (" ".join(noun() for _ in range(rng.randint(a, z))).capitalize() + rng.choice([".", ".", "?", "!"]))
    phrase = lambda: " ".join(noun() for _ in range(rng.randint(1, 5))).capitalize()
    anchor = lambda: f"<a class='l{rng.randrange(9)}' href='?{noun()}'>{phrase()}</a>"
    out = []
    for _ in range(n):
        want, inner = [], []

        def add(shape, text):
            want.append(text)  # noqa: B023
            inner.append(shape.format(text))  # noqa: B023

        add(rng.choice(["<h1 class='headline'>{}</h1>", "<header class='entry-header'><h1>{}</h1></header>", "<div><h1>{}</h1></div>"]), phrase())
        for _ in range(rng.randint(2, 9)):
            kind = rng.randrange(12)
            if kind < 6:
                add(rng.choice(["<p>{}</p>", "<p class='para'>{}</p>", "<div class='p'>{}</div>", "<p><span>{}</span></p>"]), " ".join(say(5, 20) for _ in range(rng.randint(1, 5))))
            elif kind == 6:
                add("<h3 id='s'>{}</h3>", phrase())
            elif kind == 7:
                inner.append("<ol>")
                for _ in range(rng.randint(2, 4)):
                    add("<li>{}</li>", say(2, 9))
                inner.append("</ol>")
            elif kind == 8:
                add("<blockquote>{}</blockquote>", say(6, 15))
            elif kind == 9:
                inner.append(f"<section class='{rng.choice(['chapter', 'tip', 'warning', 'related-work', 'summary'])}'>")
                add("<p>{}</p>", say(6, 20))
                add("<p>{}</p>", say(6, 20))
                inner.append("</section>")
            elif kind == 10:
                inner.append(rng.choice([f"<div class='ad-slot'>{say(3, 9)}</div>", f"<div class='share-buttons'>{anchor()} {anchor()}</div>", f"<aside class='widget'><h4>{phrase()}</h4>{anchor()}</aside>", "<script>x('<p>no</p>')</script>"]))
            else:
                t = phrase()
                want.append(t)
                inner.append(f"<p><a href='#'>{t}</a></p>")
        article = rng.choice(["<article class='post-{}'>{}</article>", "<main id='m{}'>{}</main>", "<article><div class='body-{}'>{}</div></article>", "<div class='entry-content c{}'>{}</div>"]).format(rng.randrange(99), "".join(inner))
        top = rng.choice(["<div class='topbar'>{}</div>", "<nav>{}</nav>", "<header class='site-header'><nav>{}</nav></header>", "<div id='main-menu'>{}</div>"]).format(" | ".join(anchor() for _ in range(rng.randint(3, 8))))
        side = rng.choice(["", f"<aside><h4>{phrase()}</h4><ul>{''.join('<li>' + anchor() for _ in range(5))}</ul></aside>", f"<div id='sidebar-left'><p>{say(5, 20)}</p>{anchor()}</div>"])
        talk = rng.choice(["", f"<div id='comments'><h3>{phrase()}</h3>" + "".join(f"<div class='comment-body'><b>{noun()}</b><p>{say(4, 25)}</p></div>" for _ in range(3)) + "</div>", f"<section class='discussion'><ul><li><p>{say(4, 25)}</p></ul></section>"])
        foot = rng.choice(["<footer>{}</footer>", "<div id='footer'>{}</div>"]).format(rng.choice([f"&copy; {noun()}", say(3, 9), " ".join(anchor() for _ in range(4))]))
        notice = rng.choice(["", f"<div class='cookie-banner'>{say(5, 20)}<button>Ok</button></div>", f"<form class='newsletter'><p>{say(3, 9)}</p><input></form>"])
        page = top + notice + (side + article if rng.random() < 0.5 else article + side) + talk + foot
        out.append((PAGE % (f"<div id='wrap'><div class='container'>{page}</div></div>" if rng.random() < 0.5 else page), want))
    return out


def test_pages_of_another_generator():
    right = wrong = missed = 0
    for page, want in other_sites(300, 5):
        got = MODEL.blocks(page)
        right, wrong, missed = right + len(set(want) & set(got)), wrong + len(set(got) - set(want)), missed + len(set(want) - set(got))
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_extraction_by_brute_force():
    """What the model extracts is what summing over all states of the tree gives, block by block."""
    for body in ("<nav><a href=x>Home</a></nav><article><h1>T</h1><p>Some text here.</p></article>", "<div><p>One two three.</p><ul><li>a</li><li>b</li></ul></div>", "<article class='comment'><p>Text.</p></article><footer>x</footer>"):
        page = parse(body)
        n, shares, mass, total = len(page.parent), Model.shares(page), [0.0] * len(page.parent), 0.0
        for states in itertools.product(range(3), repeat=n):
            p = MODEL.root[states[0]]
            for i in range(1, n):
                text = page.text[i] is not None
                p *= MODEL.edge(None if text else page.features[i])[states[page.parent[i]]][states[i]] * (MODEL.unary(page, i)[states[i]] ** shares[i] if text else 1)
            total += p
            for i in range(n):
                mass[i] += p * (states[i] == 1)
        assert MODEL.blocks(body) == [t for t, m in zip(page.text, mass, strict=True) if t is not None and m / total > 0.5]


def test_the_query(spark, tmp_path):
    from panelforge.llm.html_main import op4_html_extraction

    rows = [(1, "u", PAGE % f"<article><h1>Titel &uuml;</h1><p>{LONG}</p></article>"), (2, None, None), (None, "u", ""), (1, "u", PAGE % f"<article><p>{LONG}</p></article>"), (4, "v", PAGE % ("<article><p>" + LONG * 3000 + "</p></article>"))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = op4_html_extraction(spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    want = [(1, "u", "Titel ü\n\n" + LONG.strip()), (2, None, ""), (None, "u", ""), (1, "u", LONG.strip()), (4, "v", (LONG * 3000).strip())]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i, u, t, len(t)) for i, u, t in want), key=repr)
