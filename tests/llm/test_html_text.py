from __future__ import annotations

import math
from itertools import product

import pytest

from staylens.llm import html_text
from staylens.llm.html_pages import labelled_pages

MODEL = html_text.train()


def test_messages_give_the_marginals_of_the_whole_tree():
    page = html_text.parse("<body><div class=menu><p>a b c</p></div><article><p>some words to read</p><ul><li>x</li></ul></article></body>")
    features = html_text.looks(page)
    total, content = 0.0, [0.0] * len(page.nodes)
    for states in product(html_text.STATES, repeat=len(page.nodes)):
        log = MODEL.root[states[0]]
        for i, node in enumerate(page.nodes):
            log += sum(MODEL.unary[f][states[i]] for f in features[i] if f in MODEL.unary)
            if node.tag in html_text.NEVER and states[i] == html_text.CONTENT:
                log -= 50
            if i:
                log += MODEL.edge.get(node.tag, MODEL.any_edge)[states[node.parent]][states[i]]
        total += math.exp(log)
        for i, s in enumerate(states):
            content[i] += math.exp(log) * (s == html_text.CONTENT)
    assert html_text.marginals(page, MODEL) == pytest.approx([c / total for c in content])


def test_held_out_labelled_pages():
    pages = labelled_pages()
    wrong = blocks = 0
    for fold in range(4):
        model = html_text.train([p for i, p in enumerate(pages) if i % 4 != fold])
        for source in pages[fold::4]:
            page = html_text.parse(source)
            likely = html_text.marginals(page, model)
            wrong += sum((likely[i] > 0.5) != page.nodes[i].content for i, _ in page.blocks)
            blocks += len(page.blocks)
    assert wrong < 0.05 * blocks


def test_blocks_references_and_white_space():
    source = """<html><head><title>T</title><style>p{}</style><script>if (a<b) "</p>"</script></head><body><nav><a href=/>Home</a></nav>
    <article><h1>Caf&eacute; &amp; more</h1><p>One  <b>bold
    word</b><i>s</i> &#65;&#x42;&lt;p&gt;<p>Two<br>lines, long enough to be read by people</p></article><footer>&copy; x</footer>"""
    assert html_text.main_text(source, MODEL) == "Café & more\nOne bold words AB<p>\nTwo lines, long enough to be read by people"


@pytest.mark.parametrize("source", ["", "<", "<p", "<!-- ", "</p></div>", "<p>a<script>", "plain", "<p a='", "&am", "<div " * 2000, "<div>" * 3000 + "x"])
def test_broken_markup_does_not_crash(source):
    html_text.main_text(source, MODEL)


def test_rows(spark):
    page = "<body><nav><a href=/>Home</a></nav><article><p>" + "Some plain words to read. " * 5 + "</p></article></body>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", page.replace("words", "words " * 50_000))]
    df = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").selectExpr("*", "'x' AS text")
    got = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in html_text.extract(df).collect())
    text = ("Some plain words to read. " * 5).strip()
    assert got[:4] == [("1", "u", text, len(text))] * 2 + [("2", "None", "", 0), ("3", "w", got[3][2], len(got[3][2]))]
    assert got[3][3] > 1_000_000 and got[4] == ("None", "v", "", 0)
    assert html_text.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "inside",
    ["<img src=x>", "<svg><text>no</text></svg>", "<script>var x = '<p>no</p>'</script>", "<iframe src=x>no</iframe>",
     "<input name=q>", "<button>no</button>", "<button><p>no</p></button>", "<video src=x></video>", "<style>no</style>"],
)
def test_elements_in_a_line_of_text_do_not_end_its_block(inside):
    words = "some words that are long enough to be read by people"
    source = f"<body><div><p>{words} {inside} and {words}</p><p>Another one, {words}</p></div></body>"
    page = html_text.parse(source)
    said = [(page.nodes[n].tag, t) for n, t in page.blocks if "no" not in t.split()]
    assert said == [("p", f"{words} and {words}"), ("p", f"Another one, {words}")]


def test_text_of_math_and_objects_is_kept():
    words = "some words that are long enough to be read by people"
    source = (
        f"<body><article><h1>T</h1><p>{words} <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow></math> holds, "
        f"<object data=x><param name=y>a map</object> {words}</p><p>{words} <noscript>plainly</noscript></p></article></body>"
    )
    assert html_text.main_text(source, MODEL).split("\n")[1:] == [f"{words} x=2 holds, a map {words}", f"{words} plainly"]


def test_unclosed_button_does_not_swallow_its_paragraph():
    page = html_text.parse("<div><p>one <button>go</p><p>two</p></div>")
    assert [(page.nodes[n].tag, t) for n, t in page.blocks] == [("button", "go"), ("p", "one"), ("p", "two")]
