import random
import re
from collections import Counter

import duckdb

from barforge.llm import collocations, queries

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, support, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i:i + m])] += 1
    kept = {}
    frequent = {k: a for k, a in f.items() if a >= support and len(k[1]) > 1}
    for (lang, w), a in frequent.items():
        inside = any(x == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v))) and 100 * b >= 80 * a
                     for (x, v), b in frequent.items())
        if not inside:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            kept.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -score) for lang, rows in kept.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def random_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "in", "été", "ß", "x1", "co-op", "\x1c", "a b", "en", "es"]
    mark = lambda: rng.choice([" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "!"])
    langs = [None, "und", "en", "es", "", "de"]
    return [(rng.choice(langs), "".join(rng.choice(vocabulary) + mark() for _ in range(rng.randrange(60)))) for _ in range(n)]


def test_matches_brute_force(spark):
    docs = random_docs(1, 200) + [("en", None), ("fr", ""), ("fr", " . ,"), (None, None)]
    docs += [("en", "new york city hall. " * 40)] * 3 + [("de", "sehr lang und " * 30_000)]
    df = spark.createDataFrame([(i, *d, "clash", 7) for i, d in enumerate(docs)],
                               "doc_id long, lang string, text string, phrase string, f int").repartition(5)
    for support, top, shards in ((30, 2000, 5), (7, 11, 8), (2, None, 1)):
        out = collocations.collocations(df, support, top, shards)
        got = sorted(tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
        assert got and got == brute(docs, support, top)


def test_small_chunks_and_a_crowded_bitmap_change_nothing(spark, monkeypatch):
    docs = random_docs(2, 120)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    monkeypatch.setattr(collocations, "MAX_BITS", 10)
    monkeypatch.setattr(collocations, "KEPT_CODES", 3)
    got = sorted(map(tuple, collocations.collocations(df, support=4).collect()))
    assert got == brute(docs, 4, 2000)
    codes = collocations.np.array([5, 6, 0, 7, 0], dtype="uint32")
    assert [int(v.sum()) for _, _, v in collocations._levels(codes, [(5, "en")])] == [3, 1, 0, 0]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(none).count() == 0
    blank = spark.createDataFrame([("en", None), (None, " ")], "lang string, text string")
    assert collocations.collocations(blank).count() == 0


def test_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.SQL["op13_collocations"])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, queries.op13_collocations(spark, sf).select(columns).collect())) == sorted(want.fetchall())
