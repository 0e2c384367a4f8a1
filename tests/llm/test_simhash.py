import random

import xxhash

from barforge.llm import simhash


def slow_fingerprint(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """fps: [(id, fp)] -> {id: smallest id reachable}."""
    ids = [i for i, _ in fps]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(fps):
        for j, b in fps[:x]:
            if bin(a ^ b).count("1") <= 2:
                ri, rj = find(i), find(j)
                root[max(ri, rj)] = min(ri, rj)
    return {i: find(i) for i in ids}


TEXTS = ["", None, "One", "one  two", "ONE two three", "one two three four ÉtÉ  x", "a b c " * 40,
         "\x1c b\x0bc d", "word " * 70_000, "   \n\t "]


def test_fingerprint_matches_definition():
    for t in TEXTS:
        assert simhash.fingerprint((t or "").encode()) == slow_fingerprint(t)


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], "doc_id long, text string, fp string, tile int")


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(150)] for _ in range(12)]
    texts = list(TEXTS)
    for words in base:
        texts.append(" ".join(words))
        for _ in range(6):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "zz"
            texts.append(" ".join(copy))
    texts += [texts[20]] * 5
    out = {r.id: (r.fp, r.component_id) for r in simhash.simhash_components(_docs(spark, texts), block=4).collect()}
    fps = [(i, slow_fingerprint(t)) for i, t in enumerate(texts)]
    want = slow_components(fps)
    assert {i: (f & (1 << 64) - 1, c) for i, (f, c) in out.items()} == {i: (f, want[i]) for i, f in fps}


def test_links_near_random_fingerprints(spark):
    """Chains of fingerprints one to three bits apart, in blocks of eight."""
    rng = random.Random(5)
    fps = []
    for _ in range(30):
        f = rng.getrandbits(64)
        for _ in range(8):
            fps.append(f)
            for _ in range(rng.randint(0, 3)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    from barforge.llm.graph import connected_components
    got = {r.node: r.component for r in connected_components(simhash.links(simhash.tile_pairs(df, 2, 8), 2)).collect()}
    signed = sorted((f - (1 << 64) if f >> 63 else f, f) for f in fps)
    want = slow_components(signed)
    assert {i: got.get(i, i) for i, _ in signed} == want


def test_a_block_against_itself_in_another_order(spark):
    """The two lists of one block are read from a shuffle twice, in any order."""
    fps = [1 << k << 8 * k for k in range(7)] + [3, 0x7F00000000000000]
    links = simhash.links(spark.createDataFrame([(fps, fps[::-1], True)], "a array<long>, b array<long>, same boolean"), 2)
    want = slow_components([(f, f) for f in sorted(fps)])
    for src, dst in links.collect():
        assert want[src] == want[dst]


def test_empty_table_and_nulls(spark):
    none = _docs(spark, []).where("false")
    assert simhash.simhash_components(none).count() == 0
    rows = spark.createDataFrame([(None, None), (4, None), (4, "")], "doc_id long, text string")
    assert [(r.fp, r.component_id) for r in simhash.simhash_components(rows).collect()] == [(0, 4)] * 3
