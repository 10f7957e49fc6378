import numpy as np

from courtside.llm import html_blocks as H


def test_blocks_follow_the_markup():
    page = ('<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body class="a b"><nav><ul><li><a href="/x">One</a>'
            '<li>Two</ul></nav><p>A &amp; b<br>c&nbsp;&#233;<p><b>bold  text<div data-x="1>2">in <i>div</i></div><!-- no --><p></p>tail &am')
    found = H.blocks(page)
    assert [b.text for b in found] == ["One", "Two", "A & b c é", "bold text", "in div", "tail &am"]
    assert [b.path[-1][0] for b in found] == ["li", "li", "p", "p", "div", "body"]
    assert found[0].linked == 1 and found[0].path[0] == ("body", ("a", "b"))


def test_unclosed_markup_is_linear_and_safe():
    assert H.blocks("<p>x</p><script>never closed") [0].text == "x"
    assert H.blocks('<a href="x>text</a>' * 3000) is not None
    assert H.blocks("< 3 and > 2 <p>y")[0].text == "< 3 and > 2"


def test_text_after_icons_and_formulas_stays():
    for tag in ('<svg-icon name="x"></svg-icon>', '<svg class="i"/>', "<svg/>", "<math/>", "<math-renderer>", "<style-guide/>", "<title_card>",
                "<svg><path d='M0'/><text>no</text></svg>", "<object-view x='1'></object-view>", "<SCRIPT src=a>var x</script >", '<svg viewBox="0 0 1 1">',
                "<template>"):
        found = H.blocks(f"<article><p>one</p>{tag}<p>two</p><p>a{tag}b</p><p>three</p></article>")
        assert [b.text for b in found] == ["one", "two", "ab", "three"], tag
    assert [b.text for b in H.blocks("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><p>End</p>")] == ["Let x=1 be.", "End"]
    assert len(H.blocks("<p>x</p><svg>" * 20_000)) == 20_000


def test_held_out_accuracy_and_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages).collect()}
    for r in pages.collect():  # this table's template: all and only the article is main text
        found = H.blocks(r.html)
        want = "\n".join(b.text for b in found if any(t == "article" for t, _ in b.path))
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url
    net = H.BiLstm(H.N_IN)
    net.p = H.train([])
    f, held = H.Features(), H.generated_pages(200, seed=99)
    said = net.classify([f.page(b) for b, _ in held])
    assert np.mean(np.concatenate([a == y for a, (_, y) in zip(said, held)])) > 0.98


def long_page(i):
    body = "".join(f"<p>Paragraph {k} of article {i}, with some more words, and a stop.</p>" for k in range(450 + 40 * i))
    comments = "".join(f"<p>Reader {k} says a few words about it, and stops.</p>" for k in range(60))
    return (f'<html><body><nav><a href="/">Home</a></nav><article>{body}</article><div class="comments">{comments}</div>'
            "<footer><p>&copy; All rights reserved here.</p></footer></body></html>")


def test_training_sees_long_pages_to_their_end(monkeypatch):
    seen = []
    fit = H.BiLstm.fit
    monkeypatch.setattr(H.BiLstm, "fit", lambda self, pages, **k: (seen.extend(pages), fit(self, pages, **k))[1])
    pages = [long_page(i) for i in range(6)]
    net = H.BiLstm(H.N_IN)
    net.p = H.train(pages, 300)
    labels = [H.label_by_names(H.blocks(p)) for p in pages]
    assert sum(len(x) for x, _ in seen[300:]) == sum(map(len, labels)) and max(len(x) for x, _ in seen) <= 400
    assert np.array_equal(np.concatenate([y for _, y in seen[300:]]), np.concatenate(labels))
    f = H.Features()
    for said, y in zip(net.classify([f.page(H.blocks(p)) for p in pages]), labels):
        assert not said[-61:].any() and np.mean(said == y) > 0.98  # comments and footer


def test_gradients_match_differences():
    r = np.random.default_rng(0)
    net = H.BiLstm(6, hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask, y = r.standard_normal((2, 4, 6)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool), r.integers(0, 2, (2, 4))

    def loss():
        z, _ = net.forward(x, mask)
        return ((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum()

    g = net.gradients(x, mask, y)
    for k in ("wxf", "whb", "bf", "out"):
        at = (1,) * net.p[k].ndim
        keep = net.p[k][at]
        net.p[k][at] = keep + 1e-4
        up = loss()
        net.p[k][at] = keep - 1e-4
        down = loss()
        net.p[k][at] = keep
        assert abs((up - down) / 2e-4 - g[k][at]) < 1e-4, k


def test_odd_pages(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>A long enough paragraph of text, with commas, and a stop.</p>", None), (3, "v", "<nav>x</nav>", "y"),
            (3, "v", "<nav>x</nav>", "y"), (4, "w", "<article>" + "<p>Some words of an article, more words.</p>" * 3000 + "</article>", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(df).collect()
    assert len(got) == 6 and {(r.page_id, r.text) for r in got if r.page_id in (1, 2, 3)} == {(1, ""), (2, ""), (3, "")}
    assert [r.n_main for r in got if r.page_id == 4] == [3000]
    assert H.extract(df.limit(0)).count() == 0


def test_odd_markup_takes_linear_time():
    """Unclosed tags, deep nesting, closing tags of nothing, quotes and comments: twice the page, about twice the time."""
    import time

    makers = (lambda n: "<a " * n, lambda n: "<div>x" * n, lambda n: "<div>" * n + "x</section>" * n, lambda n: "<div><li>x" * n,
              lambda n: "<div class='nav'>x" * n + "</div>" * n, lambda n: '<p title="' * n + ">", lambda n: "<!-- x " * n, lambda n: "</script " * n + ">y",
              lambda n: "<svg>" * n + "t", lambda n: "<ul>" + "<div>" * n + "<li>x" * n, lambda n: "<table>" + "<option>" * n)

    def seconds(make, n):
        page, t = make(n), time.perf_counter()
        found = H.blocks(page)
        f = H.Features().page(found)
        assert len(f) == len(H.label_by_names(found)) == len(found)
        return time.perf_counter() - t

    for make in makers:
        seconds(make, 1000)
        small, large = min(seconds(make, 8_000) for _ in range(2)), min(seconds(make, 16_000) for _ in range(2))
        assert large < 2.5 * small + 0.05, make(3)


def test_open_comments_and_late_tags():
    def texts(page):
        return [b.text for b in H.blocks(page)]

    assert texts("<p>one</p>two<!-- three <p>four</p>") == ["one", "two"]
    assert texts("<p>one</p>two<!-- three") == ["one", "two"]
    assert texts("<p>one</p><!-->two") == ["one"]
    assert texts("<p>one</p>two <b three") == ["one", "two <b three"]
    assert texts("<body><p>a<body class='x'><p>b</section></div>c") == ["a", "b", "c"]
