import random

import numpy as np

from convoy.llm import language_id as I

PIECES = {"aa": "sha ton gri mel ost".split(), "bb": "zur ick löf wen erk".split(), "cc": "qui eau rre oiç tam".split()}


def _text(r, lang, n):
    return " ".join("".join(r.choices(PIECES[lang], k=r.randint(1, 3))) for _ in range(n))


def test_accuracy_mixtures_and_undetermined(spark):
    r = random.Random(7)
    rows = [(_text(r, lang, r.randint(20, 80)), lang) for lang in PIECES for _ in range(60)]
    learn = spark.createDataFrame([(i, t, lang, 0.0) for i, (t, lang) in enumerate(rows)] + [(999, None, "aa", 0.0), (998, "xx", None, 0.0)], "doc_id long, text string, lang string, score double")
    m = I.train(learn)
    assert m.langs == ["aa", "bb", "cc"]
    mixed = _text(r, "aa", 70) + " " + _text(r, "bb", 30)
    texts = [_text(r, lang, 30) for lang in PIECES for _ in range(20)] + [mixed, None, "", "12 34 !?", "_", "汉字", "ü"]
    got = I.predict(spark.createDataFrame([(i, t, "de") for i, t in enumerate(texts)], "doc_id long, text string, lang string"), m).orderBy("doc_id").collect()
    assert [x.lang_pred for x in got[:60]] == [lang for lang in PIECES for _ in range(20)] and min(x.score for x in got[:60]) > 0.9
    assert got[60].lang_pred == "aa" and 0.55 < got[60].score < 0.85
    assert [(x.lang_pred, x.score) for x in got[61:65]] == [("und", 0.0)] * 4
    assert all(x.lang_pred in m.langs and 0 <= x.score <= 1 for x in got[65:])


def test_em_finds_the_shares():
    r = np.random.default_rng(0)
    p = r.dirichlet(np.ones(200) * 0.1, 3)
    count = r.multinomial(6000, 0.6 * p[0] + 0.3 * p[1] + 0.1 * p[2])
    w, _ = I.shares(np.log(p + 1e-12), count.astype(float), 80)
    assert np.abs(w - [0.6, 0.3, 0.1]).max() < 0.03


def test_without_training_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    m = I.train(none)
    got = I.predict(spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string"), m).collect()
    assert [(x.lang_pred, x.score) for x in got] == [("und", 0.0)] and I.predict(none, m).count() == 0


def test_grams_do_not_cross_texts():
    a, n = I.grams([b"abcdef", b"", b"ab"], 4, 16)
    one = [I.grams([t], 4, 16)[0].tolist() for t in (b"abcdef", b"", b"ab")]
    assert a.tolist() == sum(one, []) and n.tolist() == [len(x) for x in one]


def test_a_language_behind_four_others_joins():
    """Five rivals of more room but little gain stand before the one that belongs."""
    p = np.full((7, 100), -9.0)
    p[0] = -3.0
    for k in range(1, 6):
        p[k, [(7 * j + 11 * k) % 92 for j in range(50)]] = -2.0
    p[6, 92:] = 3.0
    m = I.Model([f"l{k}" for k in range(7)], p.astype(np.float32), 4, 16)
    k, score = I.infer(m, np.arange(100))
    assert k == 0 and 0.85 < score < 0.97


def test_number_signs_are_no_letters(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the river and the stone", "en"), ("der Fluss und der Stein", "de")] * 6)]
    model = I.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "½ ² ① Ⅷ"), (2, "12 _ -"), (3, "ª"), (4, "the ½")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in I.predict(odd, model).collect()}
    assert got[1] == got[2] == "und" and got[3] != "und" and got[4] == "en"
