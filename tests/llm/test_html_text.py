import itertools
import random

from spendguard.llm import html_text


def test_article_among_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
    <nav><ul><li><a href=a>Home</a></li></ul></nav><!-- <p>ad</p> --><div class="ad">Buy now, really, it is cheap today.</div>
    <article><header><h1>Head &amp; tail</h1></header><p><b>First
    &lt;one&gt;.<br><p>Les.</p><p>2 < 3 is&nbsp;so.</p><div class="comments"><p>I think this is a great article, thanks a lot!</p></div>
    </article><aside><p>Related: one more story that we liked a lot.</p></aside><form><p>Your name, please, and your address.</p></form>
    <div class="cookie-notice"><p>We use cookies on this page, as all others do.</p></div><footer>&copy; us</footer>"""
    assert html_text.main_text(page) == "Head & tail\nFirst <one>.\nLes.\n2 < 3 is so."


def test_page_without_semantic_elements():
    story = "<div><div>A long paragraph of the story, which goes on and on for a while.</div><div>And here is another one of those.</div></div>"
    links = "<div><a href=1>One</a> <a href=2>Two</a></div>"
    assert html_text.main_text(links + story + links).count("\n") == 1


def test_headers_of_the_page_and_of_the_entry():
    page = """<div class="site-header"><p>The Daily Something, news since nineteen hundred and ten.</p></div>
    <div class="post"><div class="post-header"><h2>Title of it</h2></div><p>The story is told here, in one long sentence.</p></div>"""
    assert html_text.main_text(page) == "Title of it\nThe story is told here, in one long sentence."


def test_least_cut_against_all_labellings():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(0, 8)
        lean = [rng.randint(-9, 9) for _ in range(n)]
        edges = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]

        def cost(label, lean=lean, edges=edges):
            own = sum(max(0, -x) if keep else max(0, x) for x, keep in zip(lean, label, strict=True))
            return own + sum(c for i, j, c in edges if label[i] != label[j])

        every = [list(label) for label in itertools.product([False, True], repeat=n)]
        least = min(map(cost, every))
        best = max((label for label in every if cost(label) == least), key=sum)  # ties are content
        assert html_text.least_cut(lean, edges) == best


def test_awkward_pages(spark):
    pages = [None, "", "   ", "plain text of some length, without any element, is kept as content.", "<", "<p", "<p>a<!-- open", "<script>x",
             "<div " * 2000, "</p></div></x>", "<a href='>x", "<p>" + "long words and more. " * 20000 + "</p>"]
    rows = [(i, f"u{i}", p, 1, "t") for i, p in enumerate(pages)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, text string")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[0].text == by[1].text == by[2].text == "" and by[3].text == pages[3]
    assert len(by[11].text) == len("long words and more. ") * 20000 - 1
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_text.extract(df.limit(0)).count() == 0


STORY = [f"Paragraph {i} of the story goes on for quite a number of words." for i in range(5)]
BODY = "".join(f"<p>{p}</p>" for p in STORY)


def test_names_around_the_main_part_do_not_count():
    for page in (
        f'<div class="layout with-sidebar"><article>{BODY}</article></div>',
        f'<div class="post has-comments"><article>{BODY}</article></div>',
        f'<form id="aspnetForm"><article>{BODY}</article></form>',
        f'<div class="page-overlay"><main>{BODY}</main></div>',
        f'<form action="/"><div class="sidebar-left">{BODY}</div></form>',
        f'<div class="no-comments"><div>{BODY}</div></div>',
        f'<div class="modal"><div class="sidebar"><p>Read this other story of ours, please, it is good.</p></div><main>{BODY}</main></div>',
    ):
        assert html_text.main_text(page) == "\n".join(STORY), page


def test_what_is_beside_the_main_part_still_goes():
    comments = "".join(f"<article class=comment><p>I do think that comment number {i} is right, really.</p></article>" for i in range(3))
    teaser = "<div class=related><article><p>A story that is told on some other page, not on this one.</p></article></div>"
    page = f'<div class="wrap with-sidebar"><article>{BODY}</article><section class="comments">{comments}</section>{teaser}</div>'
    assert html_text.main_text(page) == "\n".join(STORY)
    hidden = f'<div style="display:none"><main>{BODY}</main></div><main>{BODY}</main>'
    assert html_text.main_text(hidden) == "\n".join(STORY)


def test_titles_of_main_and_formulas():
    page = f"<main><header><h1>The title of it</h1></header>{BODY}</main>"
    assert html_text.main_text(page) == "\n".join(["The title of it", *STORY])
    formula = "<article><p>Here <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation>a=2</annotation></math> holds, as was said above.</p></article>"
    assert html_text.main_text(formula) == "Here a=2 holds, as was said above."
