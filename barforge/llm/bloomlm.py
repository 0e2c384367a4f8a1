"""Language-model scores from a log-frequency Bloom filter (after Talbot and Osborne 2007).

Training counts words and word pairs. A count c is kept as its quantised logarithm
q = 1 + floor(log2 c): the filter holds the pairs (n-gram, 1) to (n-gram, q). Scoring
asks for (n-gram, 1), (n-gram, 2), ... until one is missing and takes the count that
the last hit stands for; an n-gram is never under-counted, and over-counted with a
chance of 2 ** -PROBES a level.

How it scales. A training task packs its n-grams into one sorted block per shard;
the blocks, not rows, are shuffled, and one task per shard adds them up and builds
that shard's part of the filter. The number of shards follows the corpus, so their
size does not grow. Scoring sends the questions to the shards, not the model to the
texts: a task takes its texts in rounds of ``round_bytes``, asks every shard for the
distinct words and pairs of a round that it owns, and one task per shard answers from
its own part alone. The answers are staged by the partition that asked; a second pass
splits the same texts into the same rounds and scores them. No part of the model passes
through the driver or is held by more than one task. The second pass has to meet the
texts of the first: ``docs`` must give the same rows in the same partitions whenever it
is read, as files do (stage what does not). A round whose n-grams are others than those
asked for ends the job.

    p(w | v) = mix * min(1, c(v w) / c(v)) + (1 - mix) * (c(w) + a) / (N + a (V + 1))

with quantised counts throughout. ``base_score`` uses exact word counts instead.

Words are told apart by 64-bit hashes. Defined cases: null text counts as empty (the
end token alone); a null id is part of no training set and is not held out; rows that
repeat an id and its text count each time and are scored each; an empty table gives
an empty result; only the id and text columns are read; a text of more than
``round_bytes`` is a round of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import open_fs, staged
from barforge.session import scratch_path

PROBES = 6
BITS_PER_ENTRY = PROBES / math.log(2)
END = np.uint64(xxhash.xxh64_intdigest(b"", 1))  # the end token, also the context of a text's first word
ONE, SHIFT = np.uint64(1), np.uint64(32)
MIX_A, MIX_B, MIX_C = (np.uint64(xxhash.xxh64_intdigest(bytes([k]), 2) | 1) for k in range(3))
BLOCK_NGRAMS = 2 << 20  # n-grams that a training task holds before it packs a block


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that close inputs spread."""
    x = (x ^ (x >> SHIFT)) * MIX_A
    x = (x ^ (x >> np.uint64(29))) * MIX_B
    return x ^ (x >> SHIFT)


def token_hashes(text: bytes) -> np.ndarray:
    """Hashes of the lower-cased words and of the end token."""
    words = text.lower().split()
    words.append(b"")
    out = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def pair_hashes(tokens: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Hash of each token with the one before it; the first of a text (at ``starts``, or just the first) follows the end token."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[0 if starts is None else starts] = END
    return mixed(before * MIX_C + (tokens ^ (tokens >> SHIFT)))


def shard_index(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard by the upper half of the hash: sorted hashes have ascending shards."""
    return ((hashes >> SHIFT) * np.uint64(shards)) >> SHIFT


def shard_cuts(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where in sorted hashes each shard begins, and the last one ends."""
    return np.searchsorted(shard_index(hashes, shards), np.arange(shards + 1, dtype=np.uint64))


def quantised(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c) for c >= 1."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def stands_for(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of 2^(q-1) .. 2^q - 1, and 0 for none."""
    return np.where(levels > 0, (3.0 * 2.0 ** (levels - 1) - 1) / 2, 0.0)


def packed(hashes: np.ndarray) -> bytes:
    """Sorted hashes as steps, first all their lowest bytes: the highest ones are zeros, which shuffles compress."""
    return np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(steps: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(steps, np.uint8).reshape(8, -1).T).view(np.uint64).ravel().cumsum(dtype=np.uint64)


def narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the fewest of 1, 2, 4 or 8 bytes each; ``widened`` needs to know how many there are."""
    most = int(numbers.max(initial=0))
    return numbers.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if most <= np.iinfo(t).max)).tobytes()


def widened(numbers: bytes, n: int) -> np.ndarray:
    width = len(numbers) // max(n, 1)
    return np.frombuffer(numbers, {1: np.uint8, 2: np.uint16, 4: np.uint32}.get(width, np.int64)).astype(np.int64)


class Filter:
    """The log-frequency Bloom filter of one shard."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.size = np.uint64(8 * len(bits))

    def _places(self, hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        first = mixed(hashes + np.uint64(level * int(MIX_C) & (1 << 64) - 1))
        return first, mixed(first) | ONE

    @classmethod
    def build(cls, hashes: np.ndarray, counts: np.ndarray) -> Filter:
        levels = quantised(counts)
        size = max(64, math.ceil(levels.sum() * BITS_PER_ENTRY / 64) * 64)
        out, marks = cls(np.zeros(size // 8, np.uint8)), np.zeros(size, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            first, step = out._places(hashes[levels >= level], level)
            for k in range(PROBES):
                marks[((first + np.uint64(k) * step) >> SHIFT) * out.size >> SHIFT] = True
        out.bits = np.packbits(marks, bitorder="little")
        return out

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Probe level after level until a miss."""
        found, left, level = np.zeros(len(hashes), np.int64), np.arange(len(hashes)), 0
        while len(left):
            level += 1
            alive = np.arange(len(left))
            first, step = self._places(hashes, level)
            for k in range(PROBES):
                at = ((first[alive] + np.uint64(k) * step[alive]) >> SHIFT) * self.size >> SHIFT
                alive = alive[self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0]
            left, hashes = left[alive], hashes[alive]
            found[left] = level
        return found


def _summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(hashes):
        return hashes, counts
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.nonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))[0]
    return hashes[first], np.add.reduceat(counts, first)


def held_out(doc_id: Column, folds: int = 10) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


# --- training ---------------------------------------------------------------

BLOCK_SCHEMA = "shard int, size int, hashes binary, counts binary"
MODEL_SCHEMA = ("shard int, tokens bigint, words bigint, entries bigint, word_bits binary, pair_bits binary, "
                "word_hashes binary, word_counts binary")
WORDS, PAIRS = 1, 2


def train(docs: DataFrame, shards: int, text_col: str = "text") -> DataFrame:
    """The model: one row per shard, staged in the shared folder."""

    def blocks(size: int, hashes: np.ndarray) -> Iterator[dict]:
        hashes, counts = np.unique(hashes, return_counts=True)
        cuts = shard_cuts(hashes, shards)
        for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if b > a:
                yield {"shard": shard, "size": size, "hashes": packed(hashes[a:b]), "counts": narrow(counts[a:b])}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("size", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])
        held: list[np.ndarray] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                starts = np.cumsum([0] + [len(t) for t in held[:-1]])
                flat = np.concatenate(held)
                held.clear()
                yield pa.RecordBatch.from_pylist(list(blocks(PAIRS, pair_hashes(flat, starts))), schema=schema)
                yield pa.RecordBatch.from_pylist(list(blocks(WORDS, flat)), schema=schema)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                tokens = token_hashes(text or b"")
                held.append(tokens)
                n += len(tokens)
                if n >= BLOCK_NGRAMS:
                    yield from flush()
                    n = 0
        yield from flush()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for row in batch.to_pylist():
                mine = held.setdefault(row["shard"], {WORDS: [], PAIRS: []})[row["size"]]
                hashes = unpacked(row["hashes"])
                mine.append((hashes, widened(row["counts"], len(hashes))))
        for shard, sizes in sorted(held.items()):
            total = {}
            for size, parts in sizes.items():
                empty = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
                total[size] = _summed(*map(np.concatenate, zip(*(parts or empty))))
                parts.clear()
            (words, word_counts), (pairs, pair_counts) = total[WORDS], total[PAIRS]
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "tokens": [int(word_counts.sum())], "words": [len(words)],
                "entries": [int(quantised(word_counts).sum() + quantised(pair_counts).sum())],
                "word_bits": [Filter.build(words, word_counts).bits.tobytes()],
                "pair_bits": [Filter.build(pairs, pair_counts).bits.tobytes()],
                "word_hashes": [words.tobytes()], "word_counts": [narrow(word_counts)]})

    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    counted = texts.mapInArrow(count, BLOCK_SCHEMA).repartitionById(shards, F.col("shard"))
    return staged(counted.mapInArrow(build, MODEL_SCHEMA), "lm")


# --- scoring ----------------------------------------------------------------

#: One row shape for the model, the questions and the answers, so that one exchange brings the first two together.
MESSAGE = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("part", pa.int32()), ("round", pa.int32()), ("digest", pa.int64()),
                     ("words", pa.binary()), ("pairs", pa.binary()), ("hashes", pa.binary()), ("counts", pa.binary())])
MESSAGE_SCHEMA = "kind int, shard int, part int, round int, digest bigint, words binary, pairs binary, hashes binary, counts binary"
MODEL, ASK = 0, 1  # a task meets its shard of the model first


class Words(dict):
    """Numbers words in the order they come; the end token is number 0."""

    def __init__(self):
        self[b""] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def hashes(self) -> np.ndarray:
        out = np.fromiter(map(xxhash.xxh64_intdigest, self), np.uint64, len(self))
        out[0] = END
        return out


class Round:
    """Texts scored together: the sorted hashes of their words, where each stands, and the hash of each pair."""

    def __init__(self, ids: list[int | None], tokens: list[np.ndarray], seen: Words):
        self.ids = ids
        self.words, back = np.unique(seen.hashes(), return_inverse=True)
        self.lengths = np.array([len(t) for t in tokens])
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])).astype(np.int64)
        self.places = back[np.concatenate(tokens)]
        self.pairs = pair_hashes(self.words[self.places], self.starts)

    def digest(self, pairs: np.ndarray) -> int:
        """Of all that is asked; ``pairs``: the distinct ones, sorted."""
        return xxhash.xxh64_intdigest(pairs.tobytes(), xxhash.xxh32_intdigest(self.words.tobytes())) - (1 << 63)


def rounds(batches: Iterator[pa.RecordBatch], round_bytes: int) -> Iterator[Round]:
    """Texts in rounds of at most ``round_bytes`` (a single longer text is a round)."""
    ids, tokens, seen, held = [], [], Words(), 0
    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or b""
            if tokens and held + len(text) > round_bytes:
                yield Round(ids, tokens, seen)
                ids, tokens, seen, held = [], [], Words(), 0
            words = text.lower().split()
            words.append(b"")
            ids.append(i.as_py())
            tokens.append(np.fromiter(map(seen.__getitem__, words), np.uint32, len(words)))
            held += len(text)
    if tokens:
        yield Round(ids, tokens, seen)


def _questions(texts: Round, shards: int, part: int, number: int) -> list[dict]:
    """What a round asks of each shard."""
    pairs = np.sort(texts.pairs)
    pairs = pairs[np.concatenate(([True], pairs[1:] != pairs[:-1]))]  # np.unique would hash them, which takes longer
    to = {"kind": ASK, "part": part, "round": number, "digest": texts.digest(pairs)}
    word_cuts, pair_cuts = shard_cuts(texts.words, shards), shard_cuts(pairs, shards)
    return [to | {"shard": k, "words": packed(texts.words[word_cuts[k]:word_cuts[k + 1]]),
                  "pairs": packed(pairs[pair_cuts[k]:pair_cuts[k + 1]])}
            for k in range(shards) if word_cuts[k] < word_cuts[k + 1] or pair_cuts[k] < pair_cuts[k + 1]]


def _answered(row: dict, model: dict | None) -> dict:
    """A question with its answers in place of the hashes: levels of words and pairs, exact counts of words."""
    words, pairs = unpacked(row["words"]), unpacked(row["pairs"])
    counts = np.zeros(len(words), np.int64)
    if model is None:
        levels = [np.zeros(len(words), np.uint8), np.zeros(len(pairs), np.uint8)]
    else:
        levels = [Filter(np.frombuffer(model[c], np.uint8)).levels(h).astype(np.uint8) for c, h in (("words", words), ("pairs", pairs))]
        known = np.frombuffer(model["hashes"], np.uint64)
        if len(known):
            at = np.minimum(np.searchsorted(known, words), len(known) - 1)
            counts = np.where(known[at] == words, model["exact"][at], 0)
    return row | {"words": levels[0].tobytes(), "pairs": levels[1].tobytes(), "counts": narrow(counts)}


def staged_answers(root: str, part: int) -> Iterator[list[dict]]:
    """The answers to one partition, round by round, by shard."""
    fs, base = open_fs(root)
    files = fs.get_file_info(pafs.FileSelector(f"{base}/part={part}", allow_not_found=True))
    held: list[dict] = []
    for path in sorted(f.path for f in files if f.path.endswith(".parquet")):
        with fs.open_input_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=64):
                for row in batch.to_pylist():
                    if held and row["round"] != held[0]["round"]:
                        yield held
                        held = []
                    held.append(row)
    if held:
        yield held


def _scored(texts: Round, answers: list[dict], totals: tuple[int, int], mix: float, add: float) -> list[pa.Array]:
    """Ids, tokens, known tokens, base score and score; ``answers`` by shard."""
    distinct, pair_places = np.unique(texts.pairs, return_inverse=True)
    if not answers or answers[0]["digest"] != texts.digest(distinct):
        raise RuntimeError("the texts of a round are not those that the model was asked for: stage docs before it is scored")
    word_levels, pair_levels = (np.frombuffer(b"".join(a[c] for a in answers), np.uint8) for c in ("words", "pairs"))
    counts = np.concatenate([widened(a["counts"], len(a["words"])) for a in answers])
    n, v = totals
    bottom = n + add * (v + 1)
    places, n_texts = texts.places, len(texts.ids)
    doc = np.repeat(np.arange(n_texts), texts.lengths)
    known = np.bincount(doc, (counts > 0)[places], n_texts).astype(np.int64)
    base = np.bincount(doc, np.log10((counts + add) / bottom)[places], n_texts)
    word, pair = stands_for(word_levels.astype(np.int64)), stands_for(pair_levels.astype(np.int64))
    before = np.roll(places, 1)
    before[texts.starts] = np.searchsorted(texts.words, END)
    p = mix * np.minimum(1.0, pair[pair_places] / np.maximum(word[before], 1.0)) + (1 - mix) * (word[places] + add) / bottom
    score = np.bincount(doc, np.log10(p), n_texts)
    return [pa.array(texts.ids, pa.int64()), *map(pa.array, (texts.lengths, known, base, score))]


def score(docs: DataFrame, model: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text",
          mix: float = 0.6, add: float = 0.1, round_bytes: int = 8 << 20) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``."""
    spark = docs.sparkSession
    sums = model.agg(F.sum("tokens"), F.sum("words")).first()
    totals = sums[0] or 0, sums[1] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = scratch_path(spark, "lm-answers")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for number, texts in enumerate(rounds(batches, round_bytes)):
            yield pa.RecordBatch.from_pylist(_questions(texts, shards, part, number), schema=MESSAGE)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["kind"] == MODEL:
                    model = row | {"exact": widened(row["counts"], len(row["hashes"]) // 8)}
                else:
                    mine = model if model and model["shard"] == row["shard"] else None
                    yield pa.RecordBatch.from_pylist([_answered(row, mine)], schema=MESSAGE)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = staged_answers(root, TaskContext.get().partitionId())
        for texts in rounds(batches, round_bytes):
            yield pa.RecordBatch.from_arrays(_scored(texts, next(answers, []), totals, mix, add),
                                             ["id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    none = F.lit(0)
    own = model.select(F.lit(MODEL).alias("kind"), "shard", none.alias("part"), none.alias("round"), none.cast("bigint").alias("digest"),
                       F.col("word_bits").alias("words"), F.col("pair_bits").alias("pairs"),
                       F.col("word_hashes").alias("hashes"), F.col("word_counts").alias("counts"))
    answered = (rows.mapInArrow(ask, MESSAGE_SCHEMA).unionByName(own).repartitionById(shards, F.col("shard"))
                .sortWithinPartitions("shard", "kind").mapInArrow(answer, MESSAGE_SCHEMA))
    (answered.select("part", "round", "shard", "digest", "words", "pairs", "counts").repartitionById(parts, F.col("part") % parts)
     .sortWithinPartitions("part", "round", "shard").write.partitionBy("part").parquet(root))
    out = rows.mapInArrow(scored, "id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select("id", "n_tokens", "n_known", F.lit(totals[0]).cast("bigint").alias("train_tokens"), "base_score", "score")


def shards_for(docs: DataFrame, text_col: str = "text", shard_bytes: int = 8 << 20) -> int:
    """Shards for a corpus: in proportion to its bytes, from 16 on."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("binary")))).first()[0] or 0
    return max(16, math.ceil(total / shard_bytes))
