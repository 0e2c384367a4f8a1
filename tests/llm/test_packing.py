import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from barforge.llm import packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, texts, size):
    """Every id in one piece, pieces gapless in their documents and sequences; returns the padding."""
    plain = Tokenizer.from_file(BYTES)
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    assert set(docs) == set(texts)
    for doc, pieces in docs.items():
        ids = np.array([*plain.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for pieces in seqs.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, len(seqs)


def test_packs_every_id_once(spark):
    rng = random.Random(7)
    texts = {i: " ".join(rng.choice(["alpha", "be", "Γ", "x1", "\n", "zeta"]) for _ in range(rng.choice([0, 3, 40, 900])))
             for i in range(300)}
    texts |= {300: None, 301: "", 302: "long " * 9000, None: "no id"}
    docs = spark.createDataFrame([(i, t, 5, 1.0) for i, t in texts.items()], "doc_id long, text string, part int, offset double")
    out = packing.pack_documents(docs.repartition(7), BYTES, size=256, open_windows=4, min_cut=8, fan_in=2, keep_ids=True)
    rows = out.collect()
    padding, n = check(rows, texts, 256)
    total = sum(r.length for r in rows)
    assert padding < 0.03 * total
    made = {r.sequence_id: r.ids for r in packing.sequences(out, 256).collect()}
    assert len(made) == n and all(len(s) == 256 or len(s) & (len(s) - 1) == 0 for s in made.values())


def test_open_windows_are_bounded():
    rng = random.Random(1)
    packer, seen = packing.Packer(64, 5), 0
    for doc in range(2000):
        closed = list(packing.pack_document(packer, doc, bytes(4 * rng.randint(1, 200)), 4, False))
        assert len(packer.windows) == len(packer.rooms) <= 5
        assert all(w.used > 64 - 4 for w in closed)
        seen += sum(p[2] for w in closed for p in w.pieces)
    assert seen > 0


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    rows = packing.pack_documents(docs, BYTES).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack_documents(docs.where("false"), BYTES).count() == 0
