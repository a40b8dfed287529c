import itertools

import numpy as np
import pytest

from voltaic.llm import extract as X
from voltaic.llm.common import read
from voltaic.llm.pages import labelled_pages

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in X.leaf_blocks(page)]


def test_leaf_blocks():
    assert texts(None) == texts("") == texts("<script>a<p>b</script><!-- <p>x</p> -->") == []
    assert texts("<p>a<b>b</b> \n c<br>d<p>e") == ["ab c d", "e"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("x &amp; y &lt;p&gt; &copy; &#233; &nbsp; z &am") == ["x & y <p> © é z &am"]
    assert texts("<head><title>t</title><style>p{}</style></head><body>b</body>") == ["b"]
    assert texts('<p title="a>b">c</p><a href=\'>\'>d</a>') == ["c", "d"]
    assert texts("<script>var t='</p>';x()</script>e<textarea><p>f</textarea>g") == ["eg"]
    assert texts("<div>a</span></section>b</div><!-- open <p>c") == ["ab"]
    assert texts("1 < 2 <3 a<") == ["1 < 2 <3 a<"]
    assert texts("<svg><text>no</text></svg>yes<noscript>no</noscript>") == ["yes"]


def test_ancestors_and_links():
    b = X.leaf_blocks('<body><div class="Menu top" id=x><p>a <a href=y>bc</a></p></div>')[0]
    assert b.ancestors == [("body", ""), ("div", "menu top x"), ("p", "")] and b.link_chars == 2 and b.tag == "p"
    assert X.leaf_blocks("<p>a<p>b")[1].ancestors == [("p", "")]


def all_paths(score, pairs):
    n = len(score)
    for path in itertools.product((0, 1), repeat=n):
        yield path, sum(score[t][y] for t, y in enumerate(path)) + sum(pairs[a][b] for a, b in itertools.pairwise(path))


def test_likelihood_and_gradient_equal_enumeration():
    rng = np.random.default_rng(0)
    size, lengths = 5, [5, 1, 3]
    score, pairs = rng.normal(size=(3, size, 2)), rng.normal(size=(2, 2))
    mask = np.arange(size) < np.array(lengths)[:, None]
    labels = rng.integers(0, 2, (3, size)) * mask

    def plain(score, pairs):
        total = 0
        for s, n, y in zip(score, lengths, labels):
            paths = dict(all_paths(s[:n], pairs))
            total += paths[tuple(y[:n])] - np.log(sum(np.exp(v) for v in paths.values()))
        return total

    value, g_score, g_pairs = X.log_likelihood(score, mask, labels, pairs)
    assert np.isclose(value, plain(score, pairs))
    for array, grad in ((score, g_score), (pairs, g_pairs)):
        for i in np.ndindex(array.shape):
            old = array[i]
            array[i] = old + 1e-6
            up = plain(score, pairs)
            array[i] = old - 1e-6
            down = plain(score, pairs)
            array[i] = old
            assert abs((up - down) / 2e-6 - grad[i]) < 1e-5


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(1)
    for n in range(1, 8):
        rows = [[f"f{i}"] for i in range(n)]
        field = X.Field({f"f{i}": rng.normal(size=2) for i in range(n)}, rng.normal(size=(2, 2)))
        best = max(all_paths(field.scores(rows), field.pairs), key=lambda x: x[1])[0]
        assert tuple(field.decode(rows)) == best
    assert field.decode([]) == []


@pytest.fixture(scope="module")
def model(spark):
    return X.train(labelled_pages(X.training_sentences(read(spark, SF, "pages")), X.TRAINING_PAGES))


def test_held_out_pages(spark, model):
    sentences = X.training_sentences(read(spark, "/root/testdata/sf0.001", "pages"))
    right = total = 0
    for page, blocks in labelled_pages(sentences, 200, seed=77):
        assert texts(page) == [t for t, _ in blocks]
        got = model.decode(X.features(X.leaf_blocks(page)))
        right += sum(a == b for a, (_, b) in zip(got, blocks))
        total += len(blocks)
    assert right / total > 0.99


def test_pages_of_other_layouts(model):
    body = "A sentence that belongs to the story and is long enough to look like prose, with a comma."
    page = (
        '<html><body><div id="cookie-consent"><p>We use cookies.</p></div><header><a href="/">Site</a></header>'
        f'<div class="main-content"><h1>Title</h1><p>{body}</p><div class="advert">Buy!</div><ul><li>{body}</li></ul><p>Short.</p></div>'
        f'<aside><h3>Related</h3><a href="/a">Other story</a></aside><section id="comments"><div class="comment"><p>{body}</p></div></section>'
        '<form><p>Your email</p></form><footer>© 2024</footer></body></html>'
    )
    assert X.main_text(page, model) == f"Title\n\n{body}\n\n{body}\n\nShort."


def test_whole_table_equals_the_article_element(spark, model):
    pages = read(spark, SF, "pages")
    html = {r.page_id: r.html for r in pages.collect()}
    got = X.extract(pages, model, ["page_id", "url"]).collect()
    assert len(got) == len(html)
    for r in got:
        h = html[r.page_id]
        article = h[h.index("<article") :].split("</article>")[0]
        assert r.text == "\n\n".join(texts(article))


def test_edge_rows(spark, model):
    rows = [(1, "u", None, "a"), (1, "u", "", "b"), (2, None, "<p>" + "word " * 100_000, "c"), (None, "v", "<nav><a href=x>m</a></nav>", "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, own string")
    got = {(r.page_id, r.url): r for r in X.extract(df, model, ["page_id", "url"]).collect()}
    assert got[1, "u"].text == "" and got[None, "v"].text == "" and len(got[2, None].text) == 499_999
    assert X.learn_and_extract(df.limit(0)).count() == 0


def test_open_heads_and_math():
    assert texts("<html><head><meta charset=x><title>t</title><link href=y><p>a<p>b") == ["a", "b"]
    assert texts("<head><script>s</script><noscript>n</noscript><template><p>no</p></template> <div>yes</div>") == ["yes"]
    assert texts("<head><title>t</title>bare text<p>c") == ["bare text", "c"]
    assert texts("<head><style>s</style><img src=i>d") == ["d"]
    assert texts("<head><title>t</title></head><p>e <math><mi>x</mi><mo>=</mo><mn>1</mn></math> f") == ["e x=1 f"]


@pytest.mark.parametrize("page, texts", [
    ('<p title=5">One.</p><p>Two.</p>', ["One.", "Two."]),
    ("<p title=it's>One.</p><p>Two it's three.</p><p>Four.</p>", ["One.", "Two it's three.", "Four."]),
    ("<p title='a > b' id=\"x>y\" data-x = 'it>s'>One.</p>", ["One."]),
    ('<a href="x"class="y">One</a> <i =odd "q" >two</i>', ["One two"]),
    ('<p title="never closed>One.</p>', []),
    ("a < b <p>c</p> <3 <p / id=x/>d", ["a < b", "c", "<3", "d"]),
])
def test_attributes_as_browsers_read_them(page, texts):
    assert [b.text for b in X.leaf_blocks(page)] == texts


def test_deep_nesting_costs_no_more_than_its_length():
    import time

    page = "".join(f"<div>text {i} " for i in range(20_000))
    start = time.process_time()
    blocks = X.leaf_blocks(page)
    rows = X.features(blocks)
    assert len(blocks) == len(rows) == 20_000 and "in:div" in rows[-1]
    page = "<b>" * 20_000 + "x</i></p>" * 2000
    assert X.leaf_blocks(page)
    assert time.process_time() - start < 6
