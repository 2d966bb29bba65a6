"""Main text of pages with and without article elements; what the ratio clustering decides."""

import random

import numpy as np

from meterline.llm import html

WORDS = "the river bends slowly past old mills and quiet meadows where herons wait for fish under a pale morning sky".split()


def paragraph(r, least=25, most=60):
    return " ".join(r.choice(WORDS) for _ in range(r.randint(least, most))).capitalize() + "."


def links(r, n, tag="div"):
    return f"<{tag}>" + " | ".join(f'<a href="/{i}">{r.choice(WORDS)}</a>' for i in range(n)) + f"</{tag}>"


def flat_page(seed):
    """A page whose body has no element around its text: link rows, a heading, paragraphs, link rows."""
    r = random.Random(seed)
    blocks = [paragraph(r) for _ in range(r.randint(4, 8))]
    if r.random() < 0.5:
        blocks.insert(2, "So it went.")
    title = " ".join(r.choice(WORDS) for _ in range(4))
    top = "".join(links(r, 6) for _ in range(r.randint(4, 7)))
    end = "".join(links(r, 5, "p") for _ in range(r.randint(4, 7)))
    body = "".join(f"<p>{x}" for x in blocks)
    return f"<html><head><title>x</title></head><body>{top}<h1>{title}</h1>{body}{end}</body></html>", "\n".join([title, *blocks])


def teaser_page(seed):
    """The text is in a plain div; the article elements hold teasers only."""
    r = random.Random(seed)
    blocks = [paragraph(r, 40, 80) for _ in range(6)]
    teasers = "".join(f'<article><a href="/{i}">{r.choice(WORDS)} {r.choice(WORDS)}</a></article>' for i in range(6))
    return f"<body>{links(r, 8)}<div>{''.join(f'<p>{x}</p>' for x in blocks)}</div><div>{teasers}</div></body>", "\n".join(blocks)


def test_clustering_decides_where_no_element_does(monkeypatch):
    pages = [f(seed) for f in (flat_page, teaser_page) for seed in range(30)]
    right = [html.main_text(page) == want for page, want in pages]
    assert np.mean(right) >= 0.95
    monkeypatch.setattr(html, "content", lambda ratio, sigma=1.0: np.ones(len(ratio), bool))
    assert np.mean([html.main_text(page) == want for page, want in pages]) <= 0.5


def test_only_named_furniture_goes():
    page = """<body><nav><a href=/>Home</a></nav><article><div class="article-header"><h1>Title</h1></div><p class="related-note">A note on the text that follows here.</p>
<p>First long paragraph of the article with a good many words in it.</p><div class="related"><a href=/1>One more</a> <a href=/2>And more</a></div>
<div class="sidebar">Side</div><div class="comments"><p>A reader says a great many words about all of this, and more.</p></div><div class="share">Share this: <a href=x>mail to a friend</a></div>
<p>Last &#8364; &amp; end.</p><footer>by me</footer></article><aside>x</aside></body>"""
    assert html.main_text(page) == "Title\nA note on the text that follows here.\nFirst long paragraph of the article with a good many words in it.\nLast € & end."


def test_smoothing_and_threshold():
    ratio = np.array([1, 2, 1, 80, 90, 3, 85, 90, 2, 1, 1], float)
    # brute force: the Gaussian by its sum, the threshold by trying every split
    r, n = 3, len(ratio)
    k = np.exp(-0.5 * np.arange(-r, r + 1) ** 2.0)
    s = np.array([sum(k[d + r] / k.sum() * ratio[min(max(i + d, 0), n - 1)] for d in range(-r, r + 1)) for i in range(n)])
    best = min((sum(((part - part.mean()) ** 2).sum() for part in (s[s < t], s[s >= t])), t) for t in np.unique(s)[1:])[1]
    assert html.content(ratio).tolist() == (s >= best).tolist()


def test_broken_and_empty_pages():
    assert [html.main_text(x) for x in (None, "", "   ", "<p>", "<script>x</script>", "<!-- x -->")] == [""] * 6
    assert html.main_text("just text &lt;b&gt;") == "just text <b>"
    assert html.main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert html.main_text("<article><p>a<p>b<ul><li>c<li>d</ul>" * 2000).count("\n") == 7999
