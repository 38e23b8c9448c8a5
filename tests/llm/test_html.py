import html as entities
import re
import time

import numpy as np
import pytest

from slotwise.llm.html import Model, NAMES, _forest, extract, labels_of, main_text, marginals, page_texts, parse, train
from slotwise.llm.layouts import labelled_layouts

LOREM = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt. Ut enim ad minim veniam."


@pytest.fixture(scope="module")
def model():
    return train(None)


def test_messages_equal_enumeration():
    page = parse("<body><div><p>one two</p>x</div><ul><li>a<li>b</ul></body>")
    rng = np.random.default_rng(1)
    model = Model(rng.normal(size=len(NAMES)), rng.normal(size=(2, 2, 2)))
    rows, parent, kind = _forest([page])
    n = len(parent)
    score, total = rows @ model.unary, 0.0
    p1 = np.zeros(n)
    for state in range(2**n):
        y = [state >> i & 1 for i in range(n)]
        w = np.exp(sum(score[i] * y[i] for i in range(n)) + sum(model.edge[kind[i], y[parent[i]], y[i]] for i in range(1, n)))
        total += w
        p1 += w * np.array(y)
    got, joint, log_total = marginals(model, rows, parent, kind)
    assert np.allclose(got, p1 / total) and np.isclose(log_total, np.log(total))
    assert np.allclose(joint[1:].sum(axis=(1, 2)), 1) and np.allclose(joint[1:, :, 1].sum(axis=1), got[1:])


def test_layouts_are_learnt(model):
    right = total = 0
    for source in labelled_layouts():
        page = parse(source)
        want = [t for t, y in zip(page.text, labels_of(page)) if t and y]
        got = extract(model, [source])[0].split("\n")
        right += got == want
        total += 1
    assert right >= 0.9 * total


@pytest.mark.parametrize("outside", [
    "<nav><a href='/'>BAD</a></nav>", "<aside><p>BAD {}</p></aside>", "<div class='sidebar'><p>BAD {}</p></div>", "<footer>BAD {}</footer>",
    "<section class='comments'><p>BAD {}</p></section>", "<div class='cookie-notice'><p>BAD {}</p></div>", "<div class='ad'>BAD {}</div>",
    "<form><p>BAD {}</p><input name='q'></form>", "<script>var a='<p>BAD</p>';</script>", "<style>.BAD{{}}</style>", "<!-- BAD <p>BAD</p> -->",
])
def test_parts_that_are_no_content(model, outside):
    part = outside.format(LOREM)
    article = f"<article><h1>Title &amp; more</h1><p>{LOREM}</p><p>Short.</p></article>"
    want = f"Title & more\n{LOREM}\nShort."
    assert extract(model, [f"<html><body>{part}{article}</body></html>", f"<html><body>{article}{part}</body></html>"]) == [want, want]


def test_white_space_entities_and_broken_markup(model):
    body = f"<article><h1> A\n\n <b>b</b>  c</h1><p>{LOREM} &lt;x&gt; &#233;<br>y<p>Second {LOREM}</p></article>"
    assert extract(model, [body])[0] == f"A b c\n{LOREM} <x> é y\nSecond {LOREM}"
    assert extract(model, ["", "<p", "a < b", "<a href='", "<table><tr><td>"])[0] == ""
    assert extract(model, [f"<article><p>{LOREM}</p><p>{LOREM} cut</arti"])[0] == f"{LOREM}\n{LOREM} cut"


def test_pages_of_the_table(spark):
    def plain(source):
        body = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", body[1])) if body else []
        parts = [" ".join(entities.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
        return "\n".join(p for p in parts if p)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in page_texts(pages).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_null_pages_and_clashing_columns(spark, model):
    df = spark.createDataFrame([(1, None, "kept", 3), (2, "", "kept", 3), (2, "", "kept", 3)], "page_id long, html string, text string, url int")
    assert [r.text for r in main_text(df, model=model).collect()] == ["", "", ""]
    assert page_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("source, want", [
    ("<body><p>one <select><option>A<option>B</select> two</p><p>three</p>", ["one two", "three"]),
    ("<body><select><optgroup><option>A<optgroup><option>B</select><p>one</p>", ["one"]),
    ("<body><datalist><option value=a><option value=b></datalist><p>one</p>", ["one"]),
    ("<body><div><option>A</div><p>one</p>", ["one"]),
    ("<head><title>t</title><h1>one</h1><p>two</p>", ["one", "two"]),
    ("<html><head><meta charset=x><title>t</title>bare text<p>two</p>", ["bare text", "two"]),
    ("<body><p>a <button><span>x</span></button> b <object><p>y</p></object> c</p>", ["a b c"]),
    ("<body><p>let <math><mi>x</mi><mspace/><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup></math> be</p>", ["let x=y2 be"]),
    ("<body><p>a <svg><g><path/><text>x</text></g></svg> b</p>", ["a b"]),
])
def test_dropped_elements_end_where_browsers_end_them(source, want):
    assert [t for t in parse(source).text if t] == want


@pytest.mark.parametrize("source, want", [
    ("<div><article><p>a</p><table><tr><td>cell</div> after</td></tr></table><p>b</p></article></div>", "article"),
    ("<article><table><tr><th>x</article> y</th></tr></table><p>b</p></article>", "article"),
    ("<article><ul><li>a</li><li>x</article></li></ul><p>b</p>", "#root"),
])
def test_end_tags_do_not_look_beyond_a_cell(source, want):
    page = parse(source)
    last = max(i for i, t in enumerate(page.text) if t == "b")
    assert page.tag[page.parent[page.parent[last]]] == want


def test_deep_nesting_takes_linear_time():
    def seconds(n):
        source = "<p><table><tr><td>" + "<b>x" * n + "</p></i></div>" * n
        begin = time.perf_counter()
        parse(source)
        return time.perf_counter() - begin

    seconds(1000)
    assert seconds(40_000) < 25 * max(seconds(4_000), 0.02)


def test_the_sample_does_not_depend_on_the_order_of_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    one, two = train(pages), train(pages.repartition(7).sortWithinPartitions("url"))
    assert np.allclose(one.unary, two.unary) and np.allclose(one.edge, two.edge)
