import io
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barforge.llm import bitpack
from barforge.llm.tokens import PieceEncoder
from barforge.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "Hello,  world\n\n x", "née Été 12 345's", " lead", "trail \t", "<|endoftext|> a<|startoftext|>b", "á e ́",
         "\x1c\x1d mixed\x85blank s", "word " * 40_000, "𝔘nicode 👩‍👩‍👧 日本語 テスト"]
CHECKED = {p: (Tokenizer.from_file(p), PieceEncoder(p, keep=5)) for p in (WORDS, BYTES)}


def plain(path, text):
    return CHECKED[path][0].encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sa1.,é́<|endoftext|>")), max_size=60))
def test_piece_encoder_equals_the_tokenizer(text):
    for path, (_, mine) in CHECKED.items():
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == plain(path, text)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_pack_round_trip(width, ids):
    ids = np.array([i & (1 << width) - 1 for i in ids], np.uint32)
    data = bitpack.pack(ids, width)
    assert len(data) == (len(ids) * width + 7) // 8
    assert bitpack.unpack(data, width, len(ids)).tolist() == ids.tolist()


def test_random_access(monkeypatch):
    monkeypatch.setattr(bitpack, "BLOCK", 16)

    class Kept(io.BytesIO):
        def close(self):
            self.data = self.getvalue()

    for width in (11, 16):
        ids = np.random.default_rng(1).integers(0, 1 << width, 333).astype("<u4")
        out, at = Kept(), 0
        writer = bitpack.Writer(out, width)
        for doc, n in enumerate([0, 1, 200, 0, 100, 32]):
            writer.add(doc if doc else None, ids[at:at + n].tobytes())
            at += n
        size = writer.close()
        assert size == len(out.data)
        reader = bitpack.Reader(io.BytesIO(out.data), size)
        for start, count in [(0, 0), (0, 1), (15, 2), (16, 16), (300, 33), (0, 333)]:
            assert reader.ids(start, count).tolist() == ids[start:start + count].tolist()
        assert [d[:3] for d in reader.documents()] == [(None, 0, 0), (1, 0, 1), (2, 1, 200), (3, 201, 0), (4, 201, 100), (5, 301, 32)]


def test_files_hold_all_documents_in_order(spark):
    rows = [(i * 3 - 4, t, 1) for i, t in enumerate(TEXTS)] + [(None, "no id", 2), (2, "again", 3)]
    out = scratch_path(spark, "pack-test")
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    manifest = bitpack.write_packed(docs, out, WORDS, 49_408, shard_bytes=50)
    got = sorted(bitpack.read_packed(manifest, out).collect(), key=lambda r: r.start)
    at = 0
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for r, (doc, text, _) in zip(got, want, strict=True):
        ids = np.array([*plain(WORDS, text), 1], "<u4")
        assert (r.id, r.start, r.n_tokens, r.ids_crc32) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert manifest.count() > 1


def test_empty_table(spark):
    out = scratch_path(spark, "pack-empty")
    manifest = bitpack.write_packed(spark.createDataFrame([], "doc_id long, text string"), out, WORDS, 49_408)
    assert bitpack.read_packed(manifest, out).count() == 0
