import itertools
import random

from concordat.llm.html_extract import extract, main_text, min_cut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li><li><a>Two</a></li></ul></nav><div class="cookie-notice">We use cookies here.</div>
<article><h1>Head &amp;   line</h1><p>First <b>sentence
 here.<br><p>Caf&eacute; &lt;b&gt; &quot;quoted&quot;&#33;</p><div class="ad">Buy this thing now.</div><ul><li>point</ul>
<section id="comments"><p>A reader comment that is rather long and has a sentence.</p></section></article>
<aside>More</aside><form><label>Mail</label><textarea>x</textarea></form><footer>&copy; us</footer></body></html>"""


def test_article_only():
    assert main_text(PAGE) == 'Head & line\nFirst sentence here.\nCafé <b> "quoted"!\npoint'


def test_head_without_end_tag():
    assert main_text(PAGE.replace("</head>", "")) == main_text(PAGE)
    head = "<html><head><title>T</title><noscript><p>No script here.</p></noscript><link rel=x><style>p{}</style>"
    body = "<p>A long paragraph of prose that goes on for a while, surely."
    want = "A long paragraph of prose that goes on for a while, surely."
    for start in ("", "<body>", "</head><body>", "<div>"):
        assert main_text(head + start + body) == want
    assert main_text("<head><title>T<body>" + body) == main_text("<head><title>T<div>" + body) == want
    assert main_text("<head><meta charset=utf-8><title>T</title><b>A long paragraph</b> of prose that goes on for a while, surely.") == want
    assert main_text("<head><title>T</title>\nA long paragraph of prose that goes on for a while, surely.") == want


PROSE = "The drug was well borne by nearly all of those who took it for a year, and few of them stopped early."


def test_names():
    assert main_text(f'<article class="post social"><p>{PROSE}</p></article>') == PROSE
    assert main_text(f'<article><p>{PROSE}</p><section class="side-effects"><p>{PROSE}</p></section></article>') == f"{PROSE}\n{PROSE}"
    for name in ("side-by-side", "market-share", "category-newsletter post", "notice-of-motion", "entry-header", "has-sidebar", "nomenclature"):
        assert main_text(f'<article class="{name}"><p>{PROSE}</p></article>') == PROSE
        if not name.startswith("category"):
            assert main_text(f'<article><div class="{name}"><p>{PROSE}</p></div></article>') == PROSE
    assert main_text(f'<div class="sidebar-right"><main><p>{PROSE}</p></main><div class="menu">x</div></div>') == PROSE
    own = "ad", "comment-list", "commentBody", "sidebar2", "site-footer", "post-comments", "cookie_banner", "related-posts", "Newsletter"
    for name in own:
        assert main_text(f'<article><p>{PROSE}</p><div class="x {name}"><p>{PROSE} {PROSE}</p></div></article>') == PROSE
    for name in ("social", "share-buttons", "tags", "byline"):
        assert main_text(f'<article><p>{PROSE}</p><div id="{name}"><p>Some words</p></div></article>') == PROSE
    # Prose outweighs a doubtful name; reader comments stay out, even those marked up as articles.
    assert main_text(f'<article><div class="social"><p>{PROSE} {PROSE}</p></div></article>') == f"{PROSE} {PROSE}"
    assert main_text(f'<article><p>{PROSE}</p><article class="comment"><p>{PROSE}</p></article></article>') == PROSE


def test_open_controls():
    for control in ("<textarea>", "<select><option>one", "<button>go", "<form><textarea name=q>", "<form><select>"):
        end = "</form>" if "form" in control else ""
        assert main_text(f"<body>{control}{end}<article><p>{PROSE}</p></article>") == PROSE
    assert main_text(f"<article><p>{PROSE}</p><textarea>some &lt;p&gt; text</textarea></article>") == PROSE


def test_formula():
    math = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='application/x-tex'>x=2</annotation></semantics></math>"
    assert main_text(f"<article><p>We find that {math} holds.</p></article>") == "We find that x=2 holds."


def test_page_without_article():
    html = "<div id=menu><a>Home</a> <a>News</a></div><div><p>A long paragraph of prose that goes on for a while, surely.</p><p>Another one.</p></div>"
    assert main_text(html) == "A long paragraph of prose that goes on for a while, surely.\nAnother one."


def test_min_cut_is_least():
    draw = random.Random(2)
    for _ in range(200):
        n = draw.randrange(1, 8)
        scores = [draw.choice((-2.0, -0.7, 0.0, 0.4, 1.5)) + draw.random() / 10 for _ in range(n)]
        edges = [(a, b, draw.random()) for a in range(n) for b in range(a + 1, n) if draw.random() < 0.5]

        def cost(label):
            own = sum(max(0.0, -s) if x else max(0.0, s) for s, x in zip(scores, label))
            return own + sum(w for a, b, w in edges if label[a] != label[b])

        assert abs(cost(min_cut(scores, edges)) - min(map(cost, itertools.product((False, True), repeat=n)))) < 1e-6


def test_edges(spark):
    deep = "<div>" * 20000 + "deep"
    many = "<article>" + "<p>Some words stand here.</p>" * 5000 + "</article>"
    rows = [(1, None), (2, ""), (3, "<p"), (4, "a < b"), (5, deep), (6, many), (6, many), (None, "<article><p>x</article>"), (7, "<nav>a</nav>")]
    df = spark.createDataFrame([(i, "u", h, "old", "z") for i, h in rows], "page_id long, url string, html string, text string, block string")
    found = sorted(extract(df).collect(), key=lambda r: (str(r.page_id), r.text))
    assert len(found) == len(rows) and [r.text for r in found if r.page_id in (1, 2, 7)] == ["", "", ""]
    assert [r.text.count("\n") for r in found if r.page_id == 6] == [4999, 4999]
    assert [r.text for r in found if r.page_id is None] == ["x"]
    assert extract(df.limit(0)).count() == 0
