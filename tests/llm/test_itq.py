import numpy as np
import pytest

from barforge.llm import itq


def brute(ids, vectors):
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([vectors[i] for i in ok], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    n, comp = dict.fromkeys(range(len(ids)), 0), {i: i for i in range(len(ids))}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, i in enumerate(ok):
        n[i] = int(near[a].sum()) - 1
        for j in (ok[b] for b in np.nonzero(near[a])[0]):
            ri, rj = find(i), find(j)
            comp[max(ri, rj)] = min(ri, rj)
    return n, {i: find(i) for i in comp}


def test_links_match_brute_force(spark):
    rng = np.random.default_rng(8)
    vectors = []
    for _ in range(120):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 6)):
            vectors.append((centre + rng.normal(size=16) * rng.choice([0.02, 0.12])).astype(np.float32).tolist())
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[0]], [0.0] * 16, None, [float("nan")] * 16, [1.0], [], [None] * 16,
                [float("inf")] + [0.0] * 15]
    df = spark.createDataFrame([(i, v, i % 3, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, size int")
    got = {r.id: (r.n_links, r.component_id) for r in itq.near_duplicates(df).collect()}
    n, comp = brute(range(len(vectors)), vectors)
    want_links, links = sum(n.values()), sum(g[0] for g in got.values())
    assert len(got) == len(vectors)
    assert all(got[i][0] <= n[i] for i in got)  # none below the threshold
    assert links >= 0.97 * want_links
    assert sum(got[i][1] == comp[i] for i in got) >= 0.97 * len(got)


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    x = np.array([r.embedding for r in df.orderBy("vec_id").collect()], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = ((x @ x.T >= 0.9).sum(axis=1) - 1)
    got = np.array([r.n_links for r in itq.near_duplicates(df).orderBy("id").collect()])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum()


def planted(rng, dims, common, pairs=250, others=1500):
    """Vectors whose random cosine is ``common``, and pairs of such vectors at cosine 0.90 to 0.92."""
    mean = np.eye(dims)[0] * np.sqrt(common)

    def free(n):
        x = rng.normal(size=(n, dims)) * (np.arange(dims) > 0)
        return x / np.linalg.norm(x, axis=1)[:, None]

    a, side, c = free(pairs), free(pairs), rng.uniform(0.90, 0.92, pairs)
    side -= (side * a).sum(axis=1)[:, None] * a
    side /= np.linalg.norm(side, axis=1)[:, None]
    turn = (c - common) / (1 - common)
    b = turn[:, None] * a + np.sqrt(1 - turn**2)[:, None] * side
    return mean + np.sqrt(1 - common) * np.concatenate((a, b, free(others)))


@pytest.mark.parametrize(("dims", "common"), [(64, 0.0), (64, 0.69), (64, 0.8), (128, 0.69)])
def test_recall_at_the_threshold_with_a_common_mean(spark, dims, common):
    x = planted(np.random.default_rng(5), dims, common)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    x /= np.linalg.norm(x, axis=1)[:, None]
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = np.array([r.n_links for r in itq.near_duplicates(df).orderBy("id").collect()])
    assert want.sum() >= 500 and (got <= want).all()
    assert got.sum() >= 0.999 * want.sum(), got.sum() / want.sum()


def test_each_length_is_a_group_of_its_own(spark):
    rng = np.random.default_rng(2)
    rows = [rng.normal(size=n).tolist() for n in [16] * 40 + [24] * 6 + [7]]
    rows += [[x * 1.01 + 0.001 for x in v] for v in rows]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component_id) for r in itq.near_duplicates(df).collect()}
    assert all(got[i][0] >= 1 and got[i][1] == got[i + 47][1] for i in range(47))


def test_empty_and_unusable(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, itq.near_duplicates(df).collect())) == [(1, 0, 1), (2, 0, 2)]
    assert itq.near_duplicates(df.where("false")).count() == 0


def test_blocks_of_a_hot_bucket_are_all_compared(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", 40)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    hot = [(centre + rng.normal(size=16) * 0.1).tolist() for _ in range(250)]  # a third, nearly all linked with each other
    vectors = hot + rng.normal(size=(500, 16)).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component_id) for r in itq.near_duplicates(df).collect()}
    n, comp = brute(range(len(vectors)), vectors)
    assert sum(n.values()) > 50_000 and all(got[i][0] <= n[i] for i in got)
    assert sum(g[0] for g in got.values()) >= 0.999 * sum(n.values())
    assert all(got[i][1] == comp[i] for i in got)


def test_plan_keeps_recall_and_grows_slowly():
    flip = np.arccos(0.9) / np.pi
    draws = np.random.default_rng(1).random((20_000, 60 * itq.WORD)) < flip  # codes of pairs at the threshold, bits independent
    last = 0
    for n in (2, 10**5, 10**7, 10**9):
        how = itq.plan(n, 0.9)
        words = draws[:, :how.tables * itq.WORD].reshape(len(draws), -1, itq.WORD)
        if how.tables <= 60:
            together = ~words[:, :, :how.key].any(axis=2) & (words[:, :, how.key:].sum(axis=2) <= itq.NEAR)
            assert together.any(axis=1).mean() > 0.999 and (words.sum(axis=(1, 2)) <= how.radius).mean() > 0.999
        assert n / 2**how.key <= max(2 * itq.BLOCK, n / 2**itq.WORD) and how.tables >= last
        last = how.tables
    assert last < 150
    assert itq.plan(10, 1.0).tables == 1


def test_few_pairs_reach_the_vectors(spark):
    x = np.random.default_rng(6).normal(size=(2000, 64))
    how = itq.plan(2000, 0.9)
    words = itq.Rotation(x / np.linalg.norm(x, axis=1)[:, None], how.tables * itq.WORD).codes(x)
    n = 0
    for t in range(how.tables):
        for key in range(2**how.key):
            rows = np.nonzero(words[:, t] >> (itq.WORD - how.key) == key)[0]
            side = itq.Side(rows, rows, words[rows], x[rows])
            n += sum(len(i) for i, _ in itq.candidates(side, side, True, t, how))
    assert n < 0.01 * 2000 * 1999 / 2
