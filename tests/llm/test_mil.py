import numpy as np

from barforge.llm import mil

SF = "/root/testdata/sf0.01"


def test_passages_cover_the_whole_text():
    words = [f"w{i}" for i in range(1000)]
    x = mil.passages(" ".join(words).encode())
    assert x.shape == (-(-1000 // mil.PASSAGE), mil.FEATURES) and np.isfinite(x).all()
    for text in (b"", b" \n\t", b"a", b"  a  b ", "é𝔘".encode(), b"x" * 200_000, b"a\nb " * 5):
        assert np.isfinite(mil.passages(text)).all() and len(mil.passages(text)) >= 1
    same, other = mil.passages(b"the the the the"), mil.passages(b"the cat sat down")
    assert same[0, 5] == 0.75 and other[0, 5] == 0.0 and same[0, 8] == 0.25 and other[0, 8] == 1.0


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    model = mil.Model(rng)
    model.p = {k: v.astype(np.float64) + rng.normal(size=v.shape) * 0.1 for k, v in model.p.items()}
    x, bag = rng.normal(size=(7, mil.FEATURES)), np.array([0, 0, 0, 1, 2, 2, 2])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        s = model.forward(x, bag, 3)[-1]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum() / weight.sum()

    grads = model.gradients(x, bag, y, weight)
    for name, grad in grads.items():
        at = tuple(rng.integers(0, n) for n in grad.shape)
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-6
        up = loss()
        model.p[name][at] = kept - 1e-6
        down = loss()
        model.p[name][at] = kept
        assert abs((up - down) / 2e-6 - grad[at]) < 1e-4, name


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = mil.fit(docs, labels)
    held = labels.where(mil.held_out(labels.doc_id)).select("doc_id", "quality")
    scored = mil.score(docs, model).withColumnRenamed("_id", "doc_id").join(held, "doc_id").collect()
    right = sum((r._score >= 0.5) == (r.quality == 1) for r in scored)
    assert right >= 0.93 * len(scored)
    again = mil.fit(docs.repartition(5), labels)
    assert all((model.p[k] == again.p[k]).all() for k in model.p)  # the same rows give the same model


def test_label_resting_on_one_passage_in_the_middle(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(240):
        text = [" ".join(rng.choice(["the", "river", "of", "stone", "and", "light"], mil.PASSAGE)) for _ in range(60)]
        if i % 2:
            text[rng.integers(25, 35)] = " ".join(["XQ7#!"] * mil.PASSAGE)
        rows.append((i, " ".join(text), i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(10_000 + i, 1) for i in range(500)], "doc_id long, quality int")
    sizes, fit = [], mil.Model.fit

    def spied(self, x, y, rng):
        sizes.extend(len(x[i]) for i in range(len(x)))
        return fit(self, x, y, rng)

    monkeypatch.setattr(mil.Model, "fit", spied)
    model = mil.fit(docs, labels, sample=100)  # labels of unknown documents take no place in the sample
    assert sizes == [60] * 100
    scored = mil.score(docs, model).collect()
    assert sum((r._score >= 0.5) == (r._id % 2 == 1) for r in scored) >= 0.95 * len(scored)


def test_nulls_empty_tables_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, None, 0.5, 1), (None, "", 0.1, 2), (2, "word " * 5000, 0.2, 3)],
                                 "doc_id long, text string, score double, y int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = mil.score(docs, mil.fit(docs, none), keep=["score", "y"]).collect()
    assert [r._score for r in out] == [0.5] * 3 and sorted(r.kept.score for r in out) == [0.1, 0.2, 0.5]
    labels = spark.createDataFrame([(2, 1), (2, 0), (1, None), (5, 0), (None, 1)], "doc_id long, quality int")
    assert len(mil.score(docs, mil.fit(docs, labels)).collect()) == 3
    assert mil.score(docs.where("false"), mil.fit(docs.where("false"), labels)).count() == 0
