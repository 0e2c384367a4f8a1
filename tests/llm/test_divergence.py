import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from barforge.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def brute(docs, least, top):
    counts, df = defaultdict(Counter), Counter()
    groups = defaultdict(set)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = terms(text)
        counts[lang, source].update(words)
        df.update((lang, w) for w in set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted(w for (x, w), n in df.items() if x == lang and n >= least)
        count = {s: {w: counts[lang, s][w] for w in kept} for s in sources}
        count[None] = {w: sum(count[s][w] for s in sources) for w in kept}
        p = {s: {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept} for s, c in count.items()}
        for s in sources:
            pairs = [(-sum(abs(p[s][w] - p[t][w]) for w in kept), t.encode()) for t in sources if t != s]
            best = [(p[None][w] - p[s][w], w.encode()) for w in kept if count[s][w] and p[s][w] > p[None][w]]
            out += [(lang, s, "pair", t.decode(), -v, r) for r, (v, t) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t.decode(), -v, r) for r, (v, t) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def random_docs(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "THE", "of", "été", "ÉTÉ", "a1b", "co-op", "x_y", "naïve", "\U0001d400", "and", "zed"]
    return [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "ß", None, "", "Z"]),
             " ".join(rng.choices(vocabulary, weights=range(1, 13), k=rng.randrange(12)))) for _ in range(n)]


def test_matches_brute_force(spark):
    docs = random_docs(3, 300) + [("en", "s9", None), ("fr", "a", "only once"), ("fr", "b", None), ("it", "alone", "")]
    docs += [("en", "s1", "long text with terms " * 20_000)] * 2
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "lang string, source string, text string, term string, n int")
    for least, top in ((30, 50), (3, 2)):
        out = divergence.source_divergences(df.repartition(6), least, 5, top)
        got = sorted(map(tuple, out.select("lang", "source", "part", "item", "value", "rank").collect()))
        assert got == brute(docs, least, top)


def test_spills_change_nothing(spark):
    docs = random_docs(4, 200)
    batch = spark.createDataFrame(docs, "lang string, source string, text string").fillna("").selectExpr(
        "cast(text as binary) as text", "lang", "source").toArrow().to_batches()
    whole = lambda: [(x["lang"], x["term"], c["source"], c["df"], c["n"]) for b in divergence._fold(iter(batch)) for x in b.to_pylist()
                     for c in x["counts"]]
    once = whole()
    divergence.STRIPE_ENTRIES, kept = 20, divergence.STRIPE_ENTRIES
    try:
        often = whole()
    finally:
        divergence.STRIPE_ENTRIES = kept
    assert len(often) >= len(once)
    total = lambda rows: {k: tuple(sum(r[i] for r in rows if r[:3] == k) for i in (3, 4)) for k in {r[:3] for r in rows}}
    assert total(once) == total(often)


def test_shares_do_not_overflow():
    counts = np.array([0, 7, 9_000_000_000_000], dtype=np.int64)
    totals = np.array([9_000_000_000_020] * 3, dtype=np.int64)
    assert divergence.shares(counts, totals, 5).tolist() == [1 + 10**9 * (c + 5) // 9_000_000_000_020 for c in counts.tolist()]


def test_empty_table(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.source_divergences(none).count() == 0


def test_query_matches_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(queries.SQL["op12_divergence"])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, queries.op12_divergence(spark, sf).select(columns).collect())) == sorted(want.fetchall())
