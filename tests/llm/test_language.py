import numpy as np

from parcelmart.llm.language import BUCKETS, learn, language_id, mixture, trigram_counts, with_languages

SCHEMA = "doc_id long, text string, lang string"
WORDS = {"aa": "the and with from this that have been", "bb": "der und mit von das nicht werden wurde", "cc": "les des avec pour dans être était"}


def say(lang, seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang].split(), n))


def rows(n=90):
    return [(i, say(lang, i), lang) for i in range(n) for lang in [list(WORDS)[i % 3]]]


EDGE = [(900, None, "aa"), (901, "", "aa"), (902, "12 ... 3 !", "bb"), (903, "the " * 90_000, None), (None, "und der das", "bb"), (904, "中文", None)]


def test_held_out_rows_and_edges(spark):
    docs = spark.createDataFrame(rows() + EDGE, SCHEMA).selectExpr("*", "1 AS score", "2 AS n", "3 AS bucket")
    got = {r.doc_id: r for r in language_id(docs).collect()}
    assert len(got) == 96 and any(r.held_out for r in got.values())
    assert all(got[i].lang_pred == lang and got[i].score > 0.9 for i, _, lang in rows())
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[903].lang_pred == "aa" and got[None].lang_pred == "bb" and 0 <= got[904].score <= 1


def test_mixtures_are_split(spark):
    model = learn(spark.createDataFrame(rows(), SCHEMA))
    mixed = spark.createDataFrame([(1, say("aa", 1, 300) + " " + say("cc", 2, 100)), (2, say("bb", 3, 60))], "doc_id long, text string")
    got = {r.doc_id: r._lang.shares for r in with_languages(mixed, model).collect()}
    assert set(got[1]) == {"aa", "cc"} and 0.6 < got[1]["aa"] < 0.85 and got[2] == {"bb": 1.0}


def test_proportions_maximise_the_likelihood():
    rng = np.random.default_rng(0)
    table = rng.dirichlet(np.full(50, 0.3), size=2).T + 1e-9
    counts = rng.multinomial(5000, table @ [0.7, 0.3])
    share = mixture(table, counts)
    grid = max(np.linspace(0.001, 0.999, 999), key=lambda a: counts @ np.log(table @ [a, 1 - a]))
    assert abs(share[0] - grid) < 0.02


def test_unlabelled_and_empty_tables(spark):
    blank = spark.createDataFrame([(1, "some text", None), (2, None, None)], SCHEMA)
    assert {(r.lang_pred, r.score) for r in language_id(blank).collect()} == {("und", 0.0)}
    assert language_id(spark.createDataFrame([], SCHEMA)).collect() == []


def test_trigrams_stay_inside_words():
    a, b = trigram_counts("Ab, cd"), trigram_counts("ab\ncd\n 7")
    assert (a[0] == b[0]).all() and a[1].sum() == b[1].sum() == 4 and a[0].max() < BUCKETS
