import random
import re

import duckdb

from barforge.llm import decontam, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found |= ids
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    rng = random.Random(4)
    vocabulary = ["the", "of", "and", "a", "Été", "x1", "co-op", "zed", "ünd", "in"]
    sentence = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, sentence(rng.choice([3, 12, 13, 14, 40]))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "?!"), (15, items[0][1]), (16, "solo"), (17, "the the the the the the the the the the the the the the")]
    docs = [(i, sentence(rng.choice([0, 5, 30]))) for i in range(20)]
    docs += [(20 + i, f"{sentence(3)}. {t or ''} , {sentence(rng.choice([2, 400]))}") for i, (_, t) in enumerate(items)]
    docs += [(50, None), (51, "the " * 40_000), (52, items[3][1].upper()), (52, items[3][1].upper()), (None, items[4][1]),
             (53, " ".join(words(items[4][1])[:-1]))]
    left = spark.createDataFrame([(*d, "clash", 9) for d in docs], "doc_id long, text string, term string, pos int")
    right = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, win int")
    got = [(r.doc_id, r.n_words, r.n_hit, sorted(r.item_ids), r.contaminated)
           for r in decontam.contamination(left, right).collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_query_matches_its_sql_on_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    want = con.execute(queries.SQL["op5_decontam"])
    columns = [c[0] for c in want.description]
    got = queries.op5_decontam(spark, sf).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_proximity(spark):
    phrase = "alpha beta gamma delta epsilon"
    docs = [(1, f"zz {phrase} zz"), (2, "alpha beta x gamma delta x epsilon"), (3, "alpha y y y y y beta gamma delta epsilon"), (4, "alpha")]
    rows = decontam.numbered(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    windows = decontam.item_windows(spark.createDataFrame([(7, phrase)], "item_id long, text string"))
    near = decontam.near_matches(rows, windows, slop=2, lists=5).join(rows, "row_id").select("doc_id").distinct()
    assert sorted(r.doc_id for r in near.collect()) == [1, 2]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontam.contamination(docs, none).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in out) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert decontam.contamination(docs.where("false"), none).count() == 0
