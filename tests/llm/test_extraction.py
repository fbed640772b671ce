import pytest

from shoplens.llm import dom, extraction as ex

BODY = ["The first paragraph of the story tells what happened in the town, and why it did so.",
        "A second one goes on at length &amp; adds detail, names and dates of all that was seen there.",
        "Last, the third paragraph closes the story with a short remark on the days to come."]
PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body>"
        "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News of the day</a></li></ul></nav><!-- <p>hidden</p> -->"
        '<div class="ad">Buy now.</div><article><h1>Story {k}</h1><p><b>{a}<br><p>{b}</p><p>{c} {k}</article><footer>All rights kept</footer></body></html>')


def _page(k):
    return PAGE.format(a=BODY[0], b=BODY[1], c=BODY[2], k=k)


def _pages(n=60):
    return [_page(k) for k in range(n)]


@pytest.fixture(scope="module")
def model():
    return ex.boost(*ex.training_rows(_pages(), 4, 1))


WANT = "Story 5 " + BODY[0] + " " + BODY[1].replace("&amp;", "&") + " " + BODY[2] + " 5"


def test_known_layout(model):
    assert ex.extract([_page(5)], model) == [WANT]


def test_other_layouts(model):
    inner = "<h1>Story 5</h1>" + "".join(f"<p>{b}</p>" for b in BODY[:2]) + f"<p>{BODY[2]} 5</p>"
    page = ('<div class="site-header"><p>My site</p></div><div class="menu"><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></div>'
            f'<div class="content">{inner}<div class="advert">Buy this <a href=x>now</a></div></div>'
            '<aside class="sidebar"><h3>Related</h3><ul><li><a href=3>Other story</a></li></ul></aside>'
            '<div class="cookie-notice"><p>We use cookies on this site.</p></div><form>Mail<input><button>Go</button></form>'
            '<div class="comments"><div class="comment"><p>Nice one, thanks for this.</p></div></div><footer>Legal</footer>')
    assert ex.extract([page], model) == [WANT]


def test_odd_pages(model):
    long = "<article>" + "".join(f"<p>{BODY[0]} {i}</p>" for i in range(3000)) + "</article>"
    deep = "<div>" * 3000 + BODY[0]
    got = ex.extract(["", "   ", "a < b and <3", "<p", "<article><p>x &lt;y&gt; &nbsp; &#233;</p></article>", long, deep], model)
    assert got[0] == got[1] == "" and got[4] == "x <y> é"
    assert got[5].startswith(BODY[0] + " 0 ") and got[5].endswith(" 2999")


def test_no_choice_contradicts_its_ancestor(model):
    for page in _pages(5):
        nodes = dom.parse(page)
        keep = ex.decode(nodes, [0.5 + 0.3 * ((k * 7) % 3 - 1) for k in range(len(nodes))])
        assert len(keep) == len(nodes)


def test_rows(spark):
    rows = [(i, f"u{i}", p, "x") for i, p in enumerate(_pages())] + [(100, None, None, "x"), (None, "u", "", "x"), (5, "u5", _page(5), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = ex.main_text(df, ex.train(df)).collect()
    assert len(got) == len(rows) and all(r.text == WANT and r.n_chars == len(WANT) for r in got if r.page_id == 5)
    assert [r.text for r in got if r.page_id in (100, None)] == ["", ""]
    empty = df.limit(0)
    assert ex.main_text(empty, ex.train(empty)).count() == 0


def _words(source):
    nodes = dom.parse(source)
    return dom.collect(nodes, [True] * len(nodes))


def test_controls_without_an_end_tag_hide_only_their_own_text():
    assert _words("<div><p>one</p><button>go<p>two</p></div>") == "one two"
    assert _words("<datalist><option>x<option>y</datalist><p>two</p>") == "two"
    assert _words("<select><option>a</option><option>b</select><p>three</p>") == "three"
    assert _words("<p>one</p><script>var a; <p>two</p>") == "one"
    assert _words("<button>go</button> on <title>t</title><p>x</p>") == "on x"
    assert _words("<p title='open>one</p><p>two</p>") == "one two"
    assert _words('<p title="a > b" id=c>one</p><!-- <p>no</p> --><?x y?><p>two') == "one two"


def test_pages_of_open_tags_take_linear_time():
    import time

    for page in ("<a" * 500_000, "<" + "x" * 1_000_000, "<a " * 100_000 + "<p>" + "<a '" * 1000, "<button>" * 20_000, "<b \"" * 100_000 + ">x"):
        start = time.process_time()
        dom.parse(page)
        assert time.process_time() - start < 30


def test_sibling_share_of_many_children():
    rows = ex.features(dom.parse("<ul>" + "<li>x</li>" * 300 + "<p>y</p>" * 100 + "</ul>"))
    assert {r[13] for r in rows[2:]} == {0.75, 0.25}


def test_pages_without_a_marked_article_are_learned_from():
    plain = [_page(k).replace("article>", "div>") for k in range(60)]
    model = ex.boost(*ex.training_rows(plain, 4, 1))
    assert model.trees and BODY[0] in ex.extract([_page(5)], model)[0]


def test_choices_together_are_no_worse_than_one_choice(model):
    import random

    rng = random.Random(4)
    for page in _pages(5):
        nodes = dom.parse(page)
        for _ in range(20):
            p = [rng.random() for _ in nodes]
            keep = ex.decode(nodes, p)
            gain = lambda choice: sum(_gain(x, q, c) for x, q, c in zip(nodes, p, choice))
            assert all(gain(keep) >= gain([same] * len(nodes)) - 1e-9 for same in (True, False))
            likely = [0.99 if k == 3 or nodes[k].parent == 3 else 0.01 for k in range(len(nodes))]
            assert [k for k, x in enumerate(ex.decode(nodes, likely)) if x] == [k for k, q in enumerate(likely) if q > 0.5]


def _gain(node, p, kept):
    import math

    w = min(4.0, 0.2 + math.log1p(sum(len(x.strip()) for x in node.parts if isinstance(x, str))) / 2)
    return w * math.log(max(1e-6, p if kept else 1 - p))
