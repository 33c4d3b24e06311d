import numpy as np

from arbora.llm import html_text as H

SCHEMA = "page_id long, url string, html string, text string, n_chars int"

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style><script>var t="<p>no</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this better.</p><button>Accept</button></div>
<article><header><h1>A  title &amp;
 more</h1></header><p>First <b>bold</b> words&hellip; and <a href="x>y">a link</a>.<br>Second line.</p>
<p>Another paragraph, with some words in it. And more of them.<p>Unclosed one is a paragraph of its own. Yes.
<ul><li>An item of the list, as text.</li><li>One more item, as text.</li></ul><!-- <p>hidden</p> --></article>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with this at all.</p></div></section>
<aside class="sidebar"><h3>Related</h3><a href="/c">Other story</a></aside>
<form><label>Name</label><input name="q"><textarea>typed</textarea><button>Send</button></form>
<footer>&copy; 2024 somebody.example</footer></body></html>"""

WANT = "\n\n".join(
    ["A title & more", "First bold words… and a link. Second line.", "Another paragraph, with some words in it. And more of them.", "Unclosed one is a paragraph of its own. Yes.", "An item of the list, as text.", "One more item, as text."]
)


def test_hand_written_page_and_edges(spark):
    long = "<article><h1>Long</h1>" + "<p>Some words of a long article, with more.</p>" * 20_000 + "</article>"
    data = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<nav><a href='/'>x</a></nav>"), (5, "u", long), (None, "u", PAGE), (6, "u", PAGE[: PAGE.index("<ul><li>An")]), (1, "u", PAGE), (7, "u", "< a & b <!")]
    got = H.extract(spark.createDataFrame([(*r, "clash", 1) for r in data], SCHEMA)).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.n_chars == len(r.text)
        if r.page_id in (1, None):
            assert r.text == WANT
        if r.page_id in (2, 3, 4):
            assert r.text == "" and r.n_chars == 0
        if r.page_id == 5:
            assert r.text.count("\n\n") == 20_000
        if r.page_id == 6:
            assert r.text == "\n\n".join(WANT.split("\n\n")[:4])
    assert H.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks():
    found = H.blocks("<ul><li>a <i>b</i><li>c</ul>t<table><tr><td>1<td>2</table><p title='a>b'>x&nbsp;&#65;<div>y</div>z<svg><p>q</p></svg>")
    assert [b[1] for b in found] == ["a b", "c", "t", "1", "2", "x A", "y", "z"]
    assert found[0][0] == ("ul", "li") and found[1][0] == ("ul", "li")
    assert H.blocks("<div class='Ad-Box x'><a href=/>go</a></div>") == [(("div", ".ad", ".box", ".x"), "go", 2, 2)]


def test_one_long_page_is_read_as_any_other(monkeypatch):
    model = H.trained()
    s = H.Sequences([H.blocks("<article><h1>Title</h1>" + "<p>Some words, with more.</p><div class=ad>Buy this now</div>" * 700 + "</article>")])
    want = model.logits(s)
    monkeypatch.setattr(H, "STEPS", 256)
    assert np.abs(model.logits(s) - want).max() < 1e-3


def test_hostile_pages_take_time_in_proportion():
    import time

    began = time.time()
    assert H.blocks("<x" * 500_000) == [] and H.blocks("<!--" * 300_000) == [] and H.blocks("<b>" * 100_000 + "</x>" * 100_000) == []
    assert H.blocks("<x a='>' " * 200_000) == [] and [t for _, t, _, _ in H.blocks("<svg>a" * 50_000)] == ["a" * 50_000]
    deep = H.blocks("<div>a" * 50_000)
    assert len(deep) == 50_000 and all(len(path) <= H.NEAR for path, *_ in deep)
    assert time.time() - began < 60


def test_markup_never_reaches_the_text():
    text = lambda page: [t for _, t, _, _ in H.blocks(page)]
    assert text("<p title=it's>hello</p>") == ["hello"] and text('<p title="a>b" x=\'>\'>c') == ["c"]
    assert text("a < b <3 c") == ["a < b <3 c"] and text("<p>cut off <b clas") == ["cut off"] and text("x<!-->y<!-- z -->w") == ["xyw"]
    assert text("<script>'</p>'</SCRIPT ><style>p</style>t<textarea><p>no</textarea>u<?php ?>v</>w") == ["tuvw"]
    assert text("<p>one<script>never closed <p>two") == ["one"] and text("<svg/><p>after</p>") == ["after"]


def test_unseen_layouts():
    model, layouts, right, total = H.trained(), H.Layouts(1234), 0, 0
    for _ in range(300):
        found, y = layouts.labelled()
        if found:
            right += int(((model.logits(H.Sequences([found])) > 0) == (y > 0)).sum())
            total += len(y)
    assert right >= 0.99 * total


def test_gradients_match_differences():
    rng = np.random.default_rng(22)
    layouts, model = H.Layouts(5), H.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    pages = [layouts.labelled() for _ in range(4)]
    s, y = H.Sequences([p for p, _ in pages]), np.concatenate([v for _, v in pages])

    def loss():
        z = model.logits(s)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    g = model.gradients(s, y)
    for k, v in model.p.items():
        flat, grad = v.reshape(-1), g[k].reshape(-1)
        for i in [int(np.abs(grad).argmax()), *rng.integers(0, len(flat), 2)]:
            was = flat[i]
            flat[i] = was + 1e-2
            up = loss()
            flat[i] = was - 1e-2
            down = loss()
            flat[i] = was
            assert abs((up - down) / 2e-2 - grad[i]) < 2e-3 + 0.03 * abs(grad[i]), k


def test_context_changes_a_label():
    """The same block reads as main text in an article and as not in a list of comments."""
    text = "<p>Words that could stand anywhere, and often do.</p>"
    main, _ = H.main_texts(H.trained(), [f"<body><article><h1>Title</h1>{text * 3}</article></body>"])
    other, _ = H.main_texts(H.trained(), [f"<body><article><h1>Title</h1><p>Yes, this is it.</p></article><div class='comments'><h3>3 comments</h3><div class='comment'>{text}</div></div></body>"])
    assert main[0].count("stand anywhere") == 3 and "stand anywhere" not in other[0]
