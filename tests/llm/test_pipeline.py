import corpus_pipeline
from barforge.llm import simhash
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_packing import check
from tests.llm.test_secrets import base_spans

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    stage = dict(corpus_pipeline.STAGES)

    first = stage["quality_classifier"](spark, docs, SF).cache()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in first.collect()}
    assert sum((i in ids) == (q == 1) for i, q in labels.items()) >= 0.8 * len(labels)  # 58 labels to learn from here
    assert first.columns == docs.columns

    second = stage["simhash_near_dedup"](spark, first, SF).cache()
    rows = sorted((r.doc_id, simhash.fingerprint((r.text or "").encode())) for r in first.collect())
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in second.collect()) == sorted(i for i in root if find(i) == i)

    third = stage["benchmark_decontamination"](spark, second, SF).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d[0] for d in contaminated([(r.doc_id, r.text) for r in second.collect()], items) if d[4]}
    assert sorted(r.doc_id for r in third.collect()) == sorted(r.doc_id for r in second.collect() if r.doc_id not in bad)

    fourth = stage["secret_scans"](spark, third, SF).cache()
    before, after = {r.doc_id: r for r in third.collect()}, {r.doc_id: r for r in fourth.collect()}
    assert before.keys() == after.keys() and fourth.schema == third.schema
    for i, r in after.items():
        assert not base_spans(r.text)
        if "[secret]" not in r.text:
            assert r == before[i]
    assert any("[secret]" in r.text for r in after.values()) == any(base_spans(r.text) for r in before.values())

    fifth = stage["packing"](spark, fourth, SF)
    padding, _ = check(fifth.collect(), {r.doc_id: r.text for r in after.values()}, 2048)
    assert padding < 0.05 * sum(r.length for r in fifth.collect())


def test_groups_that_share_an_id_keep_one_document_each(spark):
    same, other = "one two three four five", "six seven eight nine ten"
    rows = [(4, same, "a"), (4, other, "a"), (4, other, "a"), (7, same, "b"), (None, same, "c"), (None, "only this one has no id", "d"), (2, "", "e"), (9, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, [(4, same), (4, other), (None, "only this one has no id"), (2, "")]))


def test_nulls_ties_repeats_and_empty_input(spark):
    rows = [(1, None, "x", 5), (1, None, "x", 5), (None, "password=abcdefgh", None, None), (2, "", "y", 0), (3, "same text here", "z", 1),
            (4, "same text here", "z", 1), (5, "long " * 30_000, "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, row_id int")
    for given in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, SF)
            if name != "packing":
                assert out.columns == given.columns
            n = out.count()
            assert n <= given.count() or name == "packing"
