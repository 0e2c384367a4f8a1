import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm import bloomlm
from barforge.llm.bloomlm import held_out


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if w] + [None]


def test_filter_never_undercounts_and_rarely_overcounts():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    counts = rng.zipf(1.5, 20_000).clip(1, 1 << 30)
    made = bloomlm.Filter.build(hashes, counts)
    q = bloomlm.quantised(counts)
    assert (q == np.floor(np.log2(counts)).astype(int) + 1).all()
    got = made.levels(hashes)
    assert (got >= q).all() and (got > q).mean() < 0.03
    assert (made.levels(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) > 0).mean() < 0.03


def _docs(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "The", "THE"]
    texts = {i: " ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for i in range(200)}
    texts |= {200: None, 201: "", 202: "w1 w2\t\n" * 9000, 203: "never seen words", None: "w1 w2"}
    rows = [(i, t, 1.5) for i, t in texts.items()] + [(7, texts[7], 1.5), (7, "other w3", 2.5)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, score double")


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def _run(spark, df, **options):
    model = bloomlm.train(df.where(~held_out(df.doc_id)), 4)
    return bloomlm.score(df, model, 4, **options).collect()


def test_scores_match_brute_force(spark):
    rows, df = _docs(spark)
    train = [t for i, t, _ in rows if not is_held_out(i)]
    counts = Counter(w for t in train for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = _run(spark, df)
    assert len(out) == len(rows) and {r.train_tokens for r in out} == {n}
    want = sorted(((i is None, i or 0), len(words(t)), sum(counts[w] > 0 for w in words(t)),
                   round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 6)) for i, t, _ in rows)
    got = sorted(((r.id is None, r.id or 0), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in out)
    assert got == want
    assert all(r.score < 0 for r in out)

    pairs = Counter(p for t in train for p in zip([None, *words(t)], words(t)))
    level = lambda c: (3 * 2 ** (math.floor(math.log2(c))) - 1) / 2 if c else 0

    def exact(t):
        ws, total = words(t), 0.0
        for a, w in zip([None, *ws], ws):
            c = level(counts[w])
            total += math.log10(0.6 * min(1, level(pairs[a, w]) / max(1, level(counts[a])))
                                + 0.4 * (c + 0.1) / (n + 0.1 * (v + 1)))
        return total

    by = {(r.id, r.n_tokens): r.score for r in out}
    off = [abs(by[i, len(words(t))] - exact(t)) / len(words(t)) for i, t, _ in rows]
    assert sum(o < 1e-6 for o in off) > 0.3 * len(off)  # the rest met a false hit of the filter, one in 64 tokens
    assert sum(off) / len(off) < 0.05


def test_rounds_add_up_to_one_round(spark):
    _, df = _docs(spark)
    key = lambda r: (r.id is None, r.id or 0, r.n_tokens, round(r.base_score, 6), round(r.score, 6), r.n_known)
    assert sorted(map(key, _run(spark, df))) == sorted(map(key, _run(spark, df, round_bytes=10)))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert _run(spark, df) == []


def test_the_model_stays_with_its_shards(spark, monkeypatch):
    """No part of the model passes through the driver or goes to every task, in one round or in many."""
    _, df = _docs(spark)
    want = len(_run(spark, df))

    def refuse(*_, **__):
        raise AssertionError("the model left its shards")

    monkeypatch.setattr(SparkContext, "broadcast", refuse)
    for name in ("toArrow", "toPandas"):
        monkeypatch.setattr(DataFrame, name, refuse)
    model = bloomlm.train(df.where(~held_out(df.doc_id)), 4)
    for round_bytes in (100, 8 << 20):
        assert bloomlm.score(df, model, 4, round_bytes=round_bytes).count() == want


def test_every_document_held_out_scores_without_a_model(spark):
    ids = [i for i in range(400) if is_held_out(i)]
    out = _run(spark, spark.createDataFrame([(i, "w1 w2") for i in ids], "doc_id long, text string"))
    assert sorted(r.id for r in out) == ids and {(r.n_tokens, r.n_known, r.train_tokens) for r in out} == {(3, 0, 0)}
    assert all(abs(r.base_score) < 1e-9 for r in out)


def test_other_rows_in_the_second_pass_end_the_job(spark):
    """Rows that change between the passes cannot be scored from answers to other questions."""
    _, df = _docs(spark)
    model = bloomlm.train(df.where(~held_out(df.doc_id)), 4)
    again = F.udf(lambda t: f"{t} {random.random()}").asNondeterministic()
    with pytest.raises(Exception, match="stage docs"):
        bloomlm.score(df.withColumn("text", again("text")), model, 4).collect()


def test_packed_hashes_and_narrow_counts_come_back():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        hashes = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert (bloomlm.unpacked(bloomlm.packed(hashes)) == hashes).all()
        for top in (1, 255, 256, 65_535, 65_536, (1 << 32) - 1, 1 << 32, (1 << 62) + 1):
            counts = np.append(rng.integers(0, top, n), top) if n else np.empty(0, np.int64)
            assert (bloomlm.widened(bloomlm.narrow(counts), len(counts)) == counts).all()
