from __future__ import annotations

import random
import time

import numpy as np
import pytest

from shopledger.llm import htmltext as ht
from shopledger.llm.batches import Fields


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n)).capitalize() + "."


def page(rng: random.Random, article: str = "article", nav: str = "nav", footer: str = "footer"):
    """(html, main text)."""
    paragraphs = [words(rng, rng.randint(4, 60)) for _ in range(rng.randint(1, 8))]
    title = words(rng, 4)
    menu = "".join(f"<li><a href=/{i}>{words(rng, 1)}</a></li>" for i in range(rng.randint(3, 7)))
    tag = lambda name: name.split()[0]
    html = (
        f"<!DOCTYPE html><html><head><title>{title}</title><script>if (a<b) x='</p>'</script></head><body>"
        f"<{nav}><ul>{menu}</ul></{tag(nav)}><!-- c --><div class='ad'>{words(rng, 9)}</div>"
        f"<{article}><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
        + f"</{tag(article)}><{footer}>&copy; {words(rng, 12)}</{tag(footer)}></body></html>"
    )
    return html, "\n".join([title, *paragraphs])


def network(n: int = 200) -> ht.Network:
    rng = random.Random(0)
    return ht.train([page(rng)[0] for _ in range(n)], ht.Settings(epochs=20))


NETWORK = network()


def text_of(html: str, net: ht.Network = NETWORK) -> str:
    found = ht.blocks(html)
    labels = ht.label([found], net, ht.Vectors(), ht.Settings())[0]
    return "\n".join(b.text for b, main in zip(found, labels) if main)


def test_blocks_are_leaves_with_paths():
    found = ht.blocks(
        "<body><div class='a-b' id=C>x <b>y</b>&amp;z<br>w<p>p1<p>p2</div>t<ul><li>1<li>2</ul>"
        "<style>no</style><!-- no --><script>var a = '<p>no</p>'</script><p>last &lt;p&gt;"
    )
    assert [b.text for b in found] == ["x y&z w", "p1", "p2", "t", "1", "2", "last <p>"]
    assert found[0].path == ("body", "div", ".a", ".b", ".c")
    assert found[2].path[-1] == "p" and found[2].path.count("p") == 1
    assert found[5].path == ("body", "ul", "li")


def test_links_are_counted():
    found = ht.blocks("<p>ab <a href='x>y'>cd</a> ef</p><p>gh</p>")
    assert [(b.text, b.linked) for b in found] == [("ab cd ef", 2), ("gh", 0)]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = ht.Network.fresh(rng)
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    x, mask = rng.normal(size=(3, 4, ht.SIZE)), np.ones((3, 4))
    mask[1, 2:] = 0
    y = (rng.random((3, 4)) > 0.5) * 1.0

    def loss() -> float:
        p = 1 / (1 + np.exp(-net.logits(x, mask)))
        return float((-(y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum())

    found = net.gradients(x, mask, y)
    for name, w in net.weights.items():
        for _ in range(3):
            at = tuple(rng.integers(n) for n in w.shape)
            old = w[at]
            w[at] = old + 1e-3
            up = loss()
            w[at] = old - 1e-3
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-3 - found[name][at]) < 1e-4


def test_unseen_pages():
    rng = random.Random(9)
    for _ in range(50):
        html, text = page(rng)
        assert text_of(html) == text


def test_other_markup_than_in_training():
    rng = random.Random(10)
    right = total = 0
    for article, nav, footer in [
        ("main", "div class=menu", "div id=footer"),
        ("div class='post content'", "nav class=top", "footer"),
        ("section class=story", "div class='navbar'", "div class=copyright"),
    ]:
        for _ in range(20):
            html, text = page(rng, article, nav, footer)
            right += text_of(html) == text
            total += 1
    assert right >= 0.95 * total


def test_same_pages_give_the_same_network():
    again = network()
    assert all((again.weights[k] == w).all() for k, w in NETWORK.weights.items())


def test_context_decides_alike_in_any_batch():
    rng = random.Random(11)
    parsed = [ht.blocks(page(rng)[0]) for _ in range(30)]
    together = ht.label(parsed, NETWORK, ht.Vectors(), ht.Settings())
    for own, labels in zip(parsed, together):
        alone = ht.label([own], NETWORK, ht.Vectors(), ht.Settings(batch_blocks=1))[0]
        assert (alone == labels).all()


def test_odd_pages_end_soon():
    started = time.time()
    for html in ["<" * 50_000, "<div " + "a='" * 20_000, "<div>" * 20_000 + "x", "<!--" * 20_000,
                 "<p>" * 20_000, "</b>" * 20_000, "&" * 50_000, "<script>" * 5_000]:
        ht.blocks(html)
    assert time.time() - started < 60


def test_table(spark):
    rng = random.Random(12)
    html, text = page(rng)
    rows = [(1, None), (2, ""), (3, "plain words only here"), (None, html), (4, html), (4, html)]
    rows += [(5, "<body><article>" + "<p>long text of words.</p>" * 5000 + "</article>")]
    pages = spark.createDataFrame(rows, "id long, body string").selectExpr("*", "'u' AS url", "1 AS text")
    found = ht.extract(pages, NETWORK, Fields("id", "body"), carried=("url",))
    by_key = {r["key"]: r for r in found.collect()}
    assert found.count() == len(rows)
    assert by_key[1]["main_text"] == by_key[2]["main_text"] == ""
    assert by_key[None]["main_text"] == by_key[4]["main_text"] == text
    assert by_key[5]["main_text"].count("\n") == 4999 and by_key[5]["url"] == "u"
    assert ht.extract(pages.limit(0), NETWORK, Fields("id", "body")).count() == 0


def test_fit_takes_a_bounded_sample(spark):
    rng = random.Random(13)
    rows = [(i, page(rng)[0]) for i in range(60)] + [(None, "x"), (99, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    settings = ht.Settings(sample_pages=16, epochs=1)
    one = ht.fit(pages, settings=settings)
    other = ht.fit(pages.repartition(5).unionAll(pages), settings=settings)
    assert all(np.allclose(one.weights[k], w) for k, w in other.weights.items())
    empty = ht.fit(pages.limit(0), settings=settings)
    assert text_of("<p>all of it</p>", empty) == "all of it"


def test_formulas_drawings_and_embedded_things_are_text():
    found = ht.blocks(
        "<article><p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> is <svg><text>so</text></svg> it"
        "</p><noscript>plain <b>form</b></noscript><object>in <iframe>place</iframe></object>"
        "<canvas>of it</canvas><template>no</template></article>"
    )
    assert [b.text for b in found] == ["Energy E=m is so it", "plain form", "in", "place", "of it"]
    assert found[1].path == ("article", "noscript")


@pytest.mark.parametrize("depth", [5, 30, 400])
def test_telling_elements_count_at_any_depth(depth):
    wrapped = "<div class='x wrap'>" * depth
    for outer, telling in (("<nav>", "nav"), ("<div class='comments'>", ".comments"), ("<article>", "article")):
        (block,) = ht.blocks(f"<body>{outer}{wrapped}<p>text of it")
        assert telling in block.path and block.path[-4:] == ("div", ".x", ".wrap", "p")
        assert ht.by_rule([block]) == [telling == "article"]
    # A header inside the article belongs to it, one around it does not count as main text.
    inside, = ht.blocks(f"<article><header>{wrapped}<p>words of a heading here")
    around, = ht.blocks(f"<header><article>{wrapped}<p>words of a heading here")
    assert ht.by_rule([inside]) == [True] and ht.by_rule([around]) == [False]


def test_long_attributes_and_cut_tags():
    long = "a > b " * 2000
    found = ht.blocks(f"<p title=\"{long}\" class='c'>one</p><p title='{long}'>two<p data=\"x>three")
    assert [b.text for b in found] == ["one", "two", "three"]
    for cut in ('<div class="x', "<div class='x", "<div", "</div", '<div class="x" id=', "<div class=x "):
        assert [b.text for b in ht.blocks(f"<p>kept</p>{cut}")] == ["kept"]
    assert [b.text for b in ht.blocks("<p>1 < 2</p>a <")] == ["1 < 2", "a <"]


def test_an_end_tag_closes_its_element_however_many_are_open():
    found = ht.blocks("<nav>" + "<span>" * 300 + "<div>" * 300 + "in</nav>out<p>" + "<b>" * 200 + "x<p>y")
    assert [b.text for b in found] == ["in", "out", "x", "y"]
    assert found[1].path == () and found[3].path == ("p",)


def test_odd_pages_take_time_in_proportion():
    for part in ("<div>", "<b>", "</div>", "<p a='>", '<a b="x', "<", "<!--", "<script>", "<nav><b>x", "<p title='"):
        times = []
        for n in (20_000, 80_000):
            begin = time.perf_counter()
            ht.blocks(part * n + "text")
            times.append(time.perf_counter() - begin)
        assert times[1] < 12 * times[0] + 0.2, part


def plain_logits(net: ht.Network, vectors: np.ndarray) -> list[float]:
    """One page, one block and one number at a time."""
    w, size = net.weights, ht.HIDDEN

    def sigmoid(x: float) -> float:
        return 1 / (1 + np.exp(-x))

    def states(way: str, rows: list[np.ndarray]) -> list[list[float]]:
        h, c, out = [0.0] * size, [0.0] * size, []
        for x in rows:
            gates = [
                float(sum(x[k] * w["x" + way][k, j] for k in np.flatnonzero(x)))
                + sum(h[k] * w["h" + way][k, j] for k in range(size)) + w["c" + way][j]
                for j in range(4 * size)
            ]
            i, f, o = ([sigmoid(g) for g in gates[n * size : (n + 1) * size]] for n in range(3))
            c = [f[k] * c[k] + i[k] * np.tanh(gates[3 * size + k]) for k in range(size)]
            h = [o[k] * np.tanh(c[k]) for k in range(size)]
            out.append(h)
        return out

    rows = list(vectors)
    both = zip(states("f", rows), states("b", rows[::-1])[::-1])
    return [sum(a * b for a, b in zip((*f, *b), w["o"])) + float(w["oc"][0]) for f, b in both]


def test_labels_equal_a_plain_forward_pass():
    rng = random.Random(31)
    pages = [ht.blocks(page(rng)[0]) for _ in range(4)]
    found = ht.label(pages, NETWORK, ht.Vectors(), ht.Settings())
    for blocks, own in zip(pages, found):
        logits = plain_logits(NETWORK, ht.Vectors()(blocks))
        assert [x > 0 for x in logits] == own.tolist()
        x, mask = ht._batch([ht.Vectors()(blocks)])
        assert np.allclose(NETWORK.logits(x, mask)[0], logits, atol=1e-3)


def test_carried_names_may_not_clash(spark):
    pages = spark.createDataFrame([(1, "<p>x", "u")], "page_id long, html string, `text` string")
    with pytest.raises(ValueError, match="text"):
        ht.extract(pages, NETWORK, carried=("text",))
