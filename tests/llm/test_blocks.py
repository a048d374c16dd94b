import random

import numpy as np
import pytest

from parcelmart.llm import blocks

WORDS = [f"word{i}" for i in range(200)]


def page(seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choices(WORDS, k=n))
    text = [say(6), *(say(rng.randint(10, 40)) for _ in range(rng.randint(2, 5)))]
    body = f"<h1>{text[0]}</h1>" + "".join(f"<p>{t}</p>" for t in text[1:])
    head = f"<html><head><title>{text[0]}</title></head><body><nav><ul><li><a href='/'>{say(1)}</a></li><li><a>{say(1)}</a></li></ul></nav>"
    return f"{head}<div class='ad'>{say(5)}</div><article>{body}</article><footer>&copy; {say(4)}</footer></body></html>", " ".join(text)


def test_leaf_blocks():
    found = blocks.leaf_blocks(
        "<!doctype html><head><title>t</title></head><body class='a1 b-c'><!-- <p>no</p> --><script>if (a<b) '</p>'</script>out"
        "<p>one &amp;amp; <b>t</b>wo&nbsp;\n x<br>y<p>next<ul><li>l1<li>l2 <a href='>'>link</a></ul>tail</body>"
    )
    assert [(b.path[-1], b.text) for b in found] == [
        ("body.a.b.c", "out"), ("p", "one &amp; two x y"), ("p", "next"), ("li", "l1"), ("li", "l2 link"), ("body.a.b.c", "tail"),
    ]
    assert found[4].linked > 0.5 and found[0].linked == 0
    assert blocks.leaf_blocks(None) == blocks.leaf_blocks("") == blocks.leaf_blocks("<div> <p>\n</p></div><script>x") == []
    assert [b.text for b in blocks.leaf_blocks("a < b <1> c")] == ["a < b <1> c"]
    assert len(blocks.leaf_blocks("<div>" * 3000 + "deep" + "<p>x</p>" * 20_000)) == 20_001


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    pages = [rng.random((n, blocks.INPUTS)).astype(np.float32) / 20 for n in (3, 1, 5)]
    truth = [(rng.random(len(p)) < 0.5).astype(np.float32) for p in pages]
    weights = {k: w.astype(np.float64) for k, w in blocks.new_weights().items()}
    grads = {k: np.zeros_like(w) for k, w in weights.items()}
    blocks.scores(pages, weights, truth, grads)
    y = np.concatenate(truth)

    def loss():
        p = blocks.scores(pages, weights)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, w in weights.items():
        for _ in range(4):
            spot = tuple(rng.integers(0, n) for n in w.shape)
            was = w[spot]
            w[spot] = was + 1e-2
            up = loss()
            w[spot] = was - 1e-2
            down = loss()
            w[spot] = was
            assert abs((up - down) / 2e-2 - grads[name][spot]) < 2e-4


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "u", page(i)[0]) for i in range(60)]
    return blocks.fit_model(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_unseen_pages_and_edges(spark, model):
    rows = [(i, f"u{i}", page(i)[0]) for i in range(1000, 1040)] + [(1, None, None), (2, "u", ""), (None, "u", page(7)[0]), (1000, "u1000", page(1000)[0])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "'m' AS model")
    got = blocks.extract(frame, model).collect()
    assert len(got) == len(rows)
    right = sum(r.text == page(7 if r.page_id is None else r.page_id)[1] for r in got if r.page_id not in (1, 2))
    assert right >= 41 and all(r.n_chars == len(r.text) for r in got)
    assert all(r.text == "" for r in got if r.page_id in (1, 2))


def test_other_markup_is_read_too(spark, model):
    import pickle

    rng, weights = random.Random(5), pickle.loads(model)
    spare = sorted({b.text for i in range(2000, 2040) for b in blocks.leaf_blocks(page(i)[0])})
    right = total = 0
    for i in range(2000, 2100):
        article = [b for b in blocks.leaf_blocks(page(i)[0]) if blocks.marked_label(b.path)]
        shown, truth = blocks.variant(article, spare, rng)
        right += ((blocks.scores([blocks.features(shown)], weights) >= 0.5) == truth).sum()
        total += len(truth)
    assert right / total > 0.93


def test_without_marked_pages(spark):
    frame = spark.createDataFrame([(1, "u", "<div>x</div>")], "page_id long, url string, html string")
    assert [r.text for r in blocks.extract(frame).collect()] == [""]
    assert blocks.extract(frame.limit(0)).collect() == []


def test_draw_does_not_follow_size_ids_or_copies(spark):
    import pickle

    schema = "page_id long, url string, html string"
    many = spark.range(1_100_000).selectExpr("id AS page_id", "'u' AS url", "concat('<article><p>word', id, ' x</p></article>') AS html")
    assert pickle.loads(blocks.fit_model(many, 1)) is not None
    nulls = [(None, "u", page(i)[0]) for i in range(300)] + [(5, "u", page(i)[0]) for i in range(300, 600)] + [(7, "u", page(7)[0])] * 300
    sample, more = blocks.drawn_pages(spark.createDataFrame(nulls, schema), 30)
    drawn = [tuple(r) for r in sample.collect()]
    assert len(set(drawn)) == len(drawn) == 30 and more
    assert {i for i, _ in drawn} >= {None, 5}
    few, more = blocks.drawn_pages(spark.createDataFrame([(7, "u", page(7)[0])] * 300 + [(8, "u", None)], schema), 30)
    assert few.count() == 1 and not more


def test_few_marked_pages_are_found(spark):
    import pickle

    schema = "page_id long, url string, html string"
    rows = [(i, "u", page(i)[0].replace("article>", "div>")) for i in range(400)] + [(500, "u", page(500)[0])]
    assert pickle.loads(blocks.fit_model(spark.createDataFrame(rows, schema), 5)) is not None
    hidden = spark.createDataFrame([(i, "u", f"<!-- <article> --><p>{i}</p>") for i in range(9)], schema)
    with pytest.raises(ValueError, match="more pages have such tags"):
        blocks.fit_model(hidden, 5)
    assert pickle.loads(blocks.fit_model(hidden, 9)) is None
