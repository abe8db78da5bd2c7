import time

import numpy as np
import pytest

from basketflow.llm import html_extract as H
from basketflow.llm.html_blocks import blocks, describe
from tests.conftest import SMALL


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", []),
        ("<", ["<"]),
        ("3 < 4 &amp; 5 &lt; 6 &eacute;&#233;", ["3 < 4 & 5 < 6 éé"]),
        ("<div><p>one<div>two</div>three", ["one", "two", "three"]),
        ("<ul><li>a<li>b</ul>", ["a", "b"]),
        ("<!-- x <p>no</p>", []),
        ("<script>var a='<p>no</p>'</script>yes<style>p{}", ["yes"]),
        ("<head><title>no</title></head><p title='a>b'>ok</p>", ["ok"]),
        ("<a href=x>l</a> t <br>\n u&nbsp;", ["l t u"]),
        ("<p>a<!-- <p>no</p> -->b</p><noscript>no</noscript>", ["ab"]),
        ('<img alt="<p>no">x<p data-x="' + "y" * 50_000 + '<">z', ["x", "z"]),
    ],
)
def test_blocks(html, want):
    assert [b.text for b in blocks(html)] == want


def test_hostile_pages_take_linear_time():
    for page in ("<a '" * 100_000, "<" * 200_000 + "<!--" * 50_000, "<div>" * 50_000 + "x", "</p>" * 100_000, "<li>" * 50_000 + "y"):
        blocks(page)


def test_gradients():
    rng = np.random.default_rng(3)
    pages = [rng.standard_normal((n, H.SIZE)).astype(np.float32) for n in (3, 1, 5)]
    labels = [rng.integers(0, 2, len(p)).astype(np.float32) for p in pages]
    w = {k: v.astype(np.float64) for k, v in H.start_weights().items()}

    def loss():
        p = np.concatenate(H.predict(w, pages))
        y = np.concatenate(labels)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    x, sort, first, lengths = H._joined(pages)
    y = np.concatenate([labels[i] for i in sort])
    ways = [H._Pass(w, way, x, first, lengths) for way in "fb"]
    out = np.concatenate([way.forward(True) for way in ways] + [x], axis=1)
    d = (H._sigmoid(out @ w["o"] + w["c"]) - y) / len(y)
    hidden = d[:, None] * w["o"][: 2 * H.HIDDEN]
    grad = ways[0].backward(hidden[:, : H.HIDDEN]) | ways[1].backward(hidden[:, H.HIDDEN :])
    for name in ("fx", "fh", "fb", "bx", "bh", "bb"):
        at = np.unravel_index(np.argmax(np.abs(grad[name])), grad[name].shape)
        before = w[name][at]
        w[name][at] = before + 1e-3
        up = loss()
        w[name][at] = before - 1e-3
        down = loss()
        w[name][at] = before
        assert grad[name][at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=1e-5)


@pytest.fixture(scope="module")
def learned(spark):
    return H.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_pages_of_the_table(spark, learned):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(400).collect()}
    got = H.extract(list(pages.values()), learned)
    right = 0
    for html, text in zip(pages.values(), got, strict=True):
        page = blocks(html)
        right += text == "\n\n".join(b.text for b, y in zip(page, H.weak_labels(page), strict=True) if y)
    assert right / len(pages) > 0.98


def test_pages_of_other_makes(spark, learned):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(150).collect()]
    made = H.training_set(pages, layouts=4, seed=99)
    chance = H.predict(learned, [x for x, _ in made])
    wrong = sum(int(((p >= 0.5) != (y > 0)).sum()) for p, (_, y) in zip(chance, made, strict=True))
    assert wrong / sum(len(y) for _, y in made) < 0.05


def test_edge_rows(spark, learned):
    sentence = "Of the and reather thonest in a longer way than that, and with it erting on."
    long_article = "".join(f"<p>{sentence} {i} {sentence}</p>" for i in range(5000))
    rows = [(1, None), (1, None), (2, ""), (None, "<article><p>x</p></article>"), (3, "<article>" + long_article + "</article>"), (4, "no tags")]
    pages = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id long, html string, text string, doc string")
    got = H.main_text(pages, learned).collect()
    assert len(got) == len(rows)
    assert [r["text"] for r in got if not r["doc"]["html"]] == [""] * 3
    assert max(len(r["text"]) for r in got) > 200_000
    assert H.main_text(pages.limit(0), learned).count() == 0
    start = H.fit(pages.limit(0))
    assert all((start[k] == v).all() for k, v in H.start_weights().items())


def test_query(spark):
    rows = H.op6_html_extract(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_describe_is_whole():
    page = blocks("<p>a b</p><div>" + "word " * 1000 + "</div>")
    assert describe(page).shape == (2, H.SIZE) and describe([]).shape == (0, H.SIZE)


def _page(i, element, paragraphs=3):
    text = "".join(f"<p>Sentence {i} number {k} of a longer story, told in full.</p>" for k in range(paragraphs))
    return f"<body><nav><a href=/>Home</a></nav><{element}>{text}</{element}><footer>Imprint {i}</footer></body>"


def test_few_pages_that_teach_are_found(spark):
    rows = [(i, _page(i, "article" if i % 500 == 7 else "div")) for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, html string").repartition(4)
    weights = H.fit(pages, rows=6)
    got = H.extract([rows[7][1], rows[507][1]], weights)
    assert [t.count("\n\n") for t in got] == [2, 2] and "Home" not in "".join(got) and "Imprint" not in "".join(got)


def test_long_pages_teach(spark):
    rows = [(i, _page(i, "main", 2000)) for i in range(12)]
    assert all(len(html) > 50_000 for _, html in rows)
    weights = H.fit(spark.createDataFrame(rows, "page_id long, html string"))
    assert H.extract([rows[0][1]], weights)[0].count("\n\n") == 1999
    found = H.lesson(rows[0][1])
    assert found.size() <= 2 * H.TRAIN_BLOCKS and all(0 < len(y) <= H.TRAIN_BLOCKS for _, y in found.parts)


def test_tables_without_article_elements_learn_from_layouts(spark):
    rows = [(i, _page(i, "div")) for i in range(40)] + [(40, "<p>x"), (41, None), (42, "<!-- no -->")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    got = {r["doc"]["page_id"]: r["text"] for r in H.main_text(pages, H.fit(pages)).collect()}
    assert len(got) == len(rows) and got[41] == got[42] == ""
    told = [got[i] for i in range(40)]
    assert sum(t.count("longer story") == 3 for t in told) >= 36 and sum("Imprint" in t for t in told) <= 4
    bare = spark.createDataFrame([(1, "<br>"), (2, "")], "page_id long, html string")
    assert all((w == H.start_weights()[k]).all() for k, w in H.fit(bare).items())


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<html><head><meta charset=x><title>no</title><style>no</style><body><p>a</p>", ["a"]),
        ("<head><link href=x><p>a<p>b", ["a", "b"]),
        ("<head>\n <script>no</script> text<p>b", ["text", "b"]),
        ("<head><noscript><img></noscript><template><p>no</p></template></head>a", ["a"]),
        ("<head><textarea>no</textarea><p>a", ["a"]),
        ("<p>so <math><msup><mi>x</mi><mn>2</mn></msup></math> is</p>", ["so x2 is"]),
        ("<p>a <math><semantics><mi>x</mi><annotation>no</annotation></semantics></math> b</p>", ["a x b"]),
        ("<p>a</p><xmp><b>1 &amp; 2</b></xmp><p>c", ["a", "<b>1 &amp; 2</b>", "c"]),
        ("<p>a</p><plaintext><b>c</plaintext>", ["a", "<b>c</plaintext>"]),
        ("<p>a</p><!--><p>b</p>", ["a", "b"]),
        ("<p>a<!--->b<!-- no --!>c<!---->d<!-- -- > no -->e", ["abcde"]),
        ("<ul><li>a<ul><li>b<div><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<p>a <svg><title>no</title><desc>no</desc><path d='x'/>no<text x=1>in <tspan>it</tspan></text></svg> b</p>", ["a in it b"]),
        ("<p>a <svg viewBox='0 0'><style/><g><path/></g></svg> b</p>", ["a b"]),
        ("<p>a <svg/> b <svg><defs><text>no</text></defs></svg>c</p><p>d", ["a b c", "d"]),
        ("<p>a <svg><foreignObject><div>b</div><p>c<br>d</p></foreignObject>no</svg> e</p>", ["a b c d e"]),
        ("<div>a <svg><g><p>b</p></div>c", ["a", "b", "c"]),
        ("<div>a <svg><g></i></div>c", ["a", "c"]),
        ("<article><p>a <a href=x><svg><g></a> b</p></article>", ["a b"]),
    ],
)
def test_all_that_is_shown_is_cut(html, want):
    assert [b.text for b in blocks(html)] == want


def test_hostile_drawings_take_linear_time():
    for page in ("<svg><foreignObject>" * 50_000 + "</div>" * 50_000, "<svg>" + "<g>" * 50_000 + "</path>" * 50_000, "<head>" * 50_000 + "x"):
        blocks(page)


@pytest.mark.parametrize(
    "page",
    [
        "<a>" * 90_000 + "</b>" * 90_000,
        "<b>" * 60_000 + "<a>" * 60_000 + "</b>" * 60_000,
        "<div>" * 40_000 + "<li></li>" * 40_000,
        "<li><ul>" + "<div>" * 40_000 + "<li></li>" * 40_000,
        "<div>" * 30_000 + "<p>x</p>" * 30_000,
        "<a href=x>" * 50_000 + "x" + "<i>y</i>" * 50_000,
        "<!-->" * 200_000,
        "<!--" * 250_000,
        '<div class="' + "word " * 200_000 + '">x',
    ],
)
def test_a_megabyte_of_hostile_tags(page):
    began = time.time()
    found = blocks(page)
    H.weak_labels(found), describe(found)
    assert time.time() - began < 4


def test_paths_count_however_deep():
    sentence = "<p>A sentence in the middle of it all.</p>"
    deep = "<article>" + "<div>" * 400 + sentence + "</div>" * 400 + "</article>"
    assert H.weak_labels(blocks(deep)).tolist() == [1.0]
    assert H.weak_labels(blocks(f"<article><nav>{'<div>' * 400}{sentence}")).tolist() == [0.0]
    words = " ".join(f"w{chr(97 + i)}" for i in range(20))
    far, near = (describe(blocks(f'<div class="{c}">{sentence}</div>')) for c in (words, words + " sidebar"))
    assert not np.array_equal(far, near)
