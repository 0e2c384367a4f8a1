"""Quality classifier: attention-based multiple-instance learning (Ilse et al. 2018).

A document is a bag of passages: every run of ``PASSAGE`` words, so the whole text is
read. A passage is encoded by hashed counts of its words' shapes, byte pairs and
repetitions, and a layer of ``HIDDEN`` units. Gated attention weighs the passages,
learnt from the documents' labels alone; the weighted sum is scored by a logistic unit.

    h = relu(x W + b)      a = softmax over passages of w . (tanh(h V) * sigmoid(h U))
    score = sigmoid(sum(a h) . c + d)

The model is fitted with numpy on all passages of at most ``SAMPLE`` labelled documents
of the table, those with the smallest hashes of their ids. The passages are kept in
a file in the driver's temp folder, of which a mini-batch is read at a time. Scoring
reads all passages of all documents.

Defined cases: null text counts as empty; an empty text is one passage without words;
labels of unknown documents are ignored, documents with several labels count by their
largest, and of rows that repeat an id one is learnt from; without both classes among the labels every score is 0.5; an empty table
gives an empty result. Only the text enters a score.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import staged

SAMPLE = 6_000
PASSAGE = 48  # words
HIDDEN, GATE = 32, 16
PAIRS = 96  # hashed byte pairs
STATS = 16
FEATURES = STATS + PAIRS
EPOCHS, BATCH, RATE = 14, 64, 4e-3

_KIND = np.zeros(256, np.int64)  # 0 other marks, 1 lower, 2 upper, 3 digit, 4 beyond ASCII, 5 blank
_KIND[ord("a"):ord("z") + 1], _KIND[ord("A"):ord("Z") + 1], _KIND[ord("0"):ord("9") + 1] = 1, 2, 3
_KIND[128:] = 4
_KIND[[9, 10, 11, 12, 13, 32]] = 5
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


def passages(text: bytes) -> np.ndarray:
    """Features of each run of ``PASSAGE`` words: (passages, FEATURES) float32."""
    data = np.frombuffer(text or b" ", np.uint8)
    kind = _KIND[data]
    inside = kind != 5
    starts = np.nonzero(inside & np.concatenate(([True], ~inside[:-1])))[0]
    if not len(starts):
        return np.zeros((1, FEATURES), np.float32)
    ends = np.nonzero(inside & np.concatenate((~inside[1:], [True])))[0] + 1
    n = -(-len(starts) // PASSAGE)
    word_of = np.cumsum(np.bincount(starts, minlength=len(data))) - 1  # words begun up to each byte
    home = np.maximum(word_of, 0) // PASSAGE
    mine = np.arange(len(starts)) // PASSAGE

    def per_passage(weights: np.ndarray) -> np.ndarray:
        return np.bincount(mine, weights, n)

    kinds = np.bincount(home * 6 + kind, minlength=6 * n).reshape(n, 6)
    size = np.maximum(kinds[:, :5].sum(axis=1), 1)
    words = np.maximum(per_passage(np.ones(len(starts))), 1)
    lengths = ends - starts
    value = np.zeros(len(data) + 1, np.uint64)
    place = (np.arange(len(data), dtype=np.uint64) - np.repeat(starts, np.diff(np.append(starts, len(data)))).astype(np.uint64)
             if starts[0] == 0 else _places(starts, len(data)))
    lower = np.where(kind == 2, data + 32, data).astype(np.uint64)
    np.cumsum(np.where(inside, (lower + np.uint64(1)) * (place * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)), np.uint64(0)), out=value[1:])
    hashed = value[ends] - value[starts]  # equal words have equal sums
    repeats = [per_passage(np.concatenate((np.zeros(min(k, len(hashed))), hashed[k:] == hashed[:-k]))) / words for k in (1, 2, 3)]
    order = np.lexsort((hashed, mine))
    fresh = np.concatenate(([True], (hashed[order][1:] != hashed[order][:-1]) | (mine[order][1:] != mine[order][:-1])))
    distinct = np.bincount(mine[order], fresh, n) / words
    lines = np.bincount(home, data == 10, n)
    last = data[ends - 1]
    stats = np.column_stack([
        *(kinds[:, k] / size for k in range(5)), *repeats, distinct,
        per_passage(lengths) / words / 10, per_passage(lengths == 1) / words, per_passage(lengths > 14) / words,
        per_passage(_ENDS[last]) / words * 5, per_passage(_KIND[last] == 0) / words, lines / words * 5,
        per_passage(_KIND[data[starts]] == 2) / words])
    low = lower.astype(np.int64)
    both = inside[1:] & inside[:-1]
    pair = ((low[1:] * 257 + low[:-1]) * 40503 >> 4) % PAIRS
    pairs = np.bincount((home[1:] * PAIRS + pair)[both], minlength=n * PAIRS).reshape(n, PAIRS)
    return np.hstack([stats, 8 * np.sqrt(pairs / np.maximum(pairs.sum(axis=1), 1)[:, None]) - 0.5]).astype(np.float32)


def _places(starts: np.ndarray, n: int) -> np.ndarray:
    at = np.zeros(n, np.int64)
    at[starts] = starts
    return (np.arange(n) - np.maximum.accumulate(at)).astype(np.uint64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Weights and the passes through them; bags are rows of x grouped by ``bag`` (ascending)."""

    def __init__(self, rng: np.random.Generator):
        scale = lambda a, b: (rng.normal(size=(a, b)) * np.sqrt(2 / a)).astype(np.float32)
        self.mean, self.spread = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.p = {"W": scale(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": scale(HIDDEN, GATE), "U": scale(HIDDEN, GATE),
                  "w": np.zeros(GATE, np.float32), "c": scale(HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32)}
        self.known = False

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> tuple:
        p = self.p
        x = (x - self.mean) / self.spread
        h = np.maximum(x @ p["W"] + p["b"], 0)
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        e = np.exp(np.clip(e, -30, 30))
        a = e / np.bincount(bag, e, bags)[bag]
        first = np.searchsorted(bag, np.arange(bags))
        z = np.add.reduceat(a[:, None] * h, first)
        return x, h, t, g, a, first, z, _sigmoid(z @ p["c"] + p["d"])

    def gradients(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        p = self.p
        x, h, t, g, a, first, z, s = self.forward(x, bag, len(y))
        ds = (s - y) * weight / weight.sum()
        dz = ds[:, None] * p["c"]
        da = (dz[bag] * h).sum(axis=1)
        de = a * (da - np.bincount(bag, a * da, len(y))[bag])
        dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T) * (h > 0)
        return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ ds, "d": ds.sum(keepdims=True)}

    def fit(self, x: Sequence[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> None:
        n, total, squares = 0, np.zeros(FEATURES), np.zeros(FEATURES)
        for bag in x:
            n, total = n + len(bag), total + bag.sum(axis=0, dtype=np.float64)
            squares += np.square(bag, dtype=np.float64).sum(axis=0)
        mean = total / n
        self.mean = mean.astype(np.float32)
        self.spread = (np.sqrt(np.maximum(squares / n - mean * mean, 0)) + 1e-3).astype(np.float32)
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))  # classes count alike
        m, v, step = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            order = rng.permutation(len(y))
            for at in range(0, len(y), BATCH):
                pick = order[at:at + BATCH]
                part = [x[i] for i in pick]
                bag = np.repeat(np.arange(len(pick)), [len(b) for b in part])
                grads, step = self.gradients(np.concatenate(part), bag, y[pick], weight[pick]), step + 1
                for k, grad in grads.items():
                    grad = grad + 1e-4 * self.p[k]
                    m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.999 * v[k] + 0.001 * grad * grad
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        self.known = True

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if not self.known:
            return np.full(len(bags), 0.5)
        bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
        return self.forward(np.concatenate(bags), bag, len(bags))[-1].astype(np.float64)


class Bags(Sequence):
    """Bags of passages in a file, read one at a time."""

    def __init__(self, file: BinaryIO):
        self.file, self.places = file, []

    def add(self, x: bytes) -> None:
        self.places.append((self.file.seek(0, 2), len(x)))
        self.file.write(x)

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, i: int) -> np.ndarray:
        at, size = self.places[i]
        self.file.seek(at)
        return np.frombuffer(self.file.read(size), np.float32).reshape(-1, FEATURES)


def held_out(doc_id: Column, folds: int = 3) -> Column:
    """Rows whose label is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE, seed: int = 0) -> Model:
    """Learn from the labelled rows of ``docs`` that are not held out."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")))
    known = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")  # labels of unknown documents take no place
    picked = known.orderBy(F.xxhash64("id"), "id").limit(sample)  # bounded by a parameter
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    # rows that repeat an id count once: the one with the smallest text
    texts = texts.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min("text").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 16):  # a long text has many passages
                batch = whole.slice(at, 16)
                out = [passages(text or b"").tobytes() for text in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "y", "x"])

    encoded = staged(texts.select("id", "y", "text").mapInArrow(encode, "id bigint, y int, x binary"), "mil-passages")
    rng = np.random.default_rng(seed)
    model, ids, ys = Model(rng), [], []
    with tempfile.TemporaryFile() as file:
        bags = Bags(file)
        for row in encoded.toLocalIterator():
            ids.append(row["id"])
            ys.append(row["y"])
            bags.add(row["x"])
        order = np.argsort(ids)  # the same rows give the same model
        bags.places = [bags.places[i] for i in order]
        y = np.array(ys, np.float32)[order] if ids else np.zeros(0, np.float32)
        if 0 < y.sum() < len(y):
            model.fit(bags, y, rng)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(_score double, _id, and the columns to keep as the struct ``kept``) per row; the score of a text depends on nothing else."""
    rows = docs.select(F.col(text_col).cast("binary").alias("_text"), F.col(id_col).cast("bigint").alias("_id"),
                       *([F.struct(*keep).alias("kept")] if keep else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch = whole.slice(at, 128)
                made = shared.value.scores([passages(t or b"") for t in batch.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(made), *batch.columns[1:]], ["_score", *batch.schema.names[1:]])

    schema = ", ".join(["_score double", *(f"`{n}` {t}" for n, t in rows.dtypes[1:])])
    return rows.mapInArrow(run, schema)
