import random

from convoy.llm import toxicity as T

CLEAN = "the river and a green hill with some old stone houses near that quiet road of sand".split()
BAD = ["scumbag", "moronic", "worthless"]


def _texts(n, seed):
    r = random.Random(seed)
    out, label = [], []
    for i in range(n):
        w = [r.choice(CLEAN) + r.choice(["", "en", "a"]) for _ in range(r.randint(5, 60))]
        if i % 4 == 0:
            w.insert(r.randrange(len(w)), r.choice(BAD) + r.choice(["", "s", "est"]))
        out.append(" ".join(w))
        label.append(int(i % 4 == 0))
    return out, label


def test_separates_held_out_texts_and_ignores_other_columns(spark, docs_of):
    texts, label = _texts(400, 1)
    docs = docs_of(texts)
    labels = spark.createDataFrame([(i, 0, x) for i, x in enumerate(label) if i < 300], "doc_id long, quality int, toxic int")
    net = T.train(docs, labels, T.Params(steps=200))
    got = {r.doc_id: r.score for r in T.score(docs.drop("score"), net).collect()}
    held = [(got[i] >= net.p.cutoff) == bool(label[i]) for i in range(300, 400)]
    assert len(got) == 400 and sum(held) >= 97 and all(0 <= x <= 1 for x in got.values())
    again = T.train(docs, labels, T.Params(steps=200))
    assert {r.doc_id: r.score for r in T.score(docs.drop("score"), again).collect()} == got


def test_score_depends_on_the_text_alone(spark, docs_of):
    net = T.ConvNet(T.Params())
    long_ = "word " * 30_000
    texts = [None, "", " \n", "moron", "moron", long_, "the moron"]
    one = [T.net_scores(net, T.Vocabulary(net.p.bits), T.pa.array([t], T.pa.string()))[0][0] for t in texts]
    got = [r.score for r in T.score(docs_of(texts).drop("score"), net).orderBy("doc_id").collect()]
    assert got[0] == got[1] == got[2] and got[3] == got[4]
    assert all(abs(T.np.log(g / (1 - g)) - z) < 1e-4 for g, z in zip(got, one))


def test_empty_tables_and_single_class(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    net = T.train(docs_of(["a b", None]), none, T.Params(steps=5))
    assert [r.score for r in T.score(docs_of(["a b", None]).drop("score"), net).collect()] == [0.0, 0.0]
    assert T.score(docs_of([]).drop("score"), net).count() == 0
    odd = spark.createDataFrame([(None, 1), (0, None), (1, 0), (9, 1)], "doc_id long, toxic int")
    assert T.train(docs_of(["a b", None]), odd, T.Params(steps=5)).const == -T.np.inf


def test_training_sample_is_not_lowered_for_memory():
    assert T.Params().sample == 8000


def test_every_labelled_row_is_learnt_from(spark, docs_of):
    # a word that only rows beyond the first fit show
    texts, label = _texts(600, 3)
    docs = docs_of(texts)
    order = [r.doc_id for r in docs.select("doc_id").orderBy(T.F.xxhash64("doc_id"), "doc_id").collect()]
    late = set(order[300:])
    rare = [t if i not in late or not label[i] else " ".join(w if not any(w.startswith(b) for b in BAD) else "vermin" for w in t.split())
            for i, t in enumerate(texts)]
    docs = docs_of(rare)
    labels = spark.createDataFrame(list(enumerate(label)), "doc_id long, toxic int")
    p = dict(sample=100, steps=200, share=200, passes=20)
    net = T.train(docs, labels, T.Params(**p))
    row = T.zlib.crc32(b"vermin") & ((1 << net.p.bits) - 1)
    first = T.ConvNet(net.p)
    assert abs(net.emb[row] - first.emb[row]).max() > 0  # learnt, though not in the first fit
    got = {r.doc_id: r.score for r in T.score(docs.drop("score"), net).collect()}
    assert sum((got[i] >= net.p.cutoff) == bool(x) for i, x in enumerate(label)) >= 560
    again = T.train(docs, labels, T.Params(**p))
    assert {r.doc_id: r.score for r in T.score(docs.drop("score"), again).collect()} == got
