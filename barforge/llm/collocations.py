"""Phrase collocations by partitioned mining (Savasere, Omiecinski and Navathe 1995).

The documents fall into ``shards`` shards by a hash of their text. A phrase that occurs
``support`` times overall occurs at least ``ceil(support / shards)`` times in some shard,
whatever the shards' sizes. Each shard is mined completely at that lowered support, level
by level: a phrase of n words is counted only where both its parts of n - 1 words are
locally frequent. The union over the shards is then counted exactly over all documents,
with the phrases' own words as the keys.

A shard is a part of the key, not a task: every task reads its own documents of all
shards, counts its phrases in arrays of ``CHUNK`` bytes at a time, and Spark adds
up the counts. The number of shards is fixed and small (3), so the lowered support does not sink to 1
as the input grows. What a level found goes to the next as a bitmap of at most
2^``MAX_BITS`` bits (32 MB): false positives of a crowded bitmap, and hashes that
collide, only add candidates that the exact count throws out again.

Defined cases: null texts are empty; a null language is ``und``, together with rows that
say so; a language without words has no row; rows that repeat a document count again; a
very long text is one run of words whatever its length (a task holds the words of its
longest document); an empty table gives no rows. Only the language and text columns are
read, whatever else there is.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import staged

LONGEST = 4
CHUNK = 14_000_000  # bytes of text or codes counted at a time in a task: 2 to 4 million words
KEPT_CODES = 1_000_000
MAX_BITS = 28
BITS_PER_KEY = 16
SHARD_MASK = 7  # the low bits of a mining key hold the shard

ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(string.ascii_uppercase.encode() + ENDS, string.ascii_lowercase.encode() + b"\n" * len(ENDS))
END = bytes(4)
BREAK = b"."  # no word holds a full stop, so it can stand for the end of a piece

MIX = np.uint64(0x9E3779B97F4A7C15)
PROBES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xCA5A826395121157))


def words_and_breaks(text: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 text, with ``BREAK`` between the words of different pieces."""
    return text.translate(TABLE).replace(b"\n", b" . ").split()


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * MIX
    return h ^ (h >> np.uint64(29))


class Bitmap:
    """A bit for each of two hashes of a key: no key that was put in is missed."""

    def __init__(self, bits: int, words: np.ndarray):
        self.shift = np.uint64(64 - bits)
        self.bytes = words.view(np.uint8)

    @staticmethod
    def positions(keys: np.ndarray, shift: np.uint64) -> list[np.ndarray]:
        return [((keys ^ (keys >> np.uint64(31))) * m) >> shift for m in PROBES]

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for at in self.positions(keys, self.shift):
            out &= (self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def bitmap_of(keys: DataFrame, bits_per_key: int = BITS_PER_KEY) -> Bitmap:
    """Bitmap of a table of bigint keys, set up by Spark; at most 2^MAX_BITS bits reach the driver."""
    wanted = max(1, keys.count()) * bits_per_key
    bits = min(MAX_BITS, max(10, (wanted - 1).bit_length()))
    shift = np.uint64(64 - bits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(Bitmap.positions(batch.column(0).to_numpy().view(np.uint64), shift))
            bit = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(bit)], ["word", "bit"])

    found = keys.mapInArrow(place, "word int, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.uint64)
    words[found["word"].to_numpy()] = found["bit"].to_numpy().view(np.uint64)
    return Bitmap(bits, words)


class _Codes(dict):
    """32-bit codes of words, of as many as fit; 0 is a break."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_CODES:
            self.clear()
        code = self[word] = 0 if word == BREAK else xxhash.xxh32_intdigest(word) or 1
        return code


def _levels(codes: np.ndarray, docs: list[tuple[int, str]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, keys, valid): for each place the key of the n words from there on, and whether a piece holds them.

    ``docs`` has the number of codes and the language of each document. Keys leave the shard's bits free.
    """
    salts = {lang: xxhash.xxh64_intdigest(lang.encode(), 1) for _, lang in docs}
    salt = np.repeat(np.array([salts[lang] for _, lang in docs], dtype=np.uint64), [n for n, _ in docs])
    inside = codes != 0
    chain, valid = codes.astype(np.uint64), inside
    for n in range(1, LONGEST + 1):
        if n > 1:
            chain = _mix(chain[:-1]) + codes[n - 1:]
            valid = valid[:-1] & inside[n - 1:]
        yield n, _mix(chain ^ salt[:len(chain)]) & ~np.uint64(SHARD_MASK), valid


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """First columns (bytes), languages and shards of documents with words, ``CHUNK`` bytes or more at a time."""
    texts, langs, shards, size = [], [], [], 0
    for batch in batches:
        for text, lang, shard in zip(*(batch.column(c).to_pylist() for c in range(3))):
            texts.append(text)
            langs.append(lang)
            shards.append(shard)
            size += len(text)
            if size >= CHUNK:
                yield texts, langs, shards
                texts, langs, shards, size = [], [], [], 0
    if size:
        yield texts, langs, shards


def _shares(docs: DataFrame, lang_col: str, text_col: str, shards: int) -> DataFrame:
    """(text, lang, shard)."""
    if not 1 <= shards <= SHARD_MASK + 1:
        raise ValueError(f"shards must be 1 to {SHARD_MASK + 1}")
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(text.alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(text), F.lit(shards)).cast("int").alias("shard"))


def encoded(shares: DataFrame) -> DataFrame:
    """(codes binary, lang, shard): a 32-bit code for each word, 0 for each break and at the end; written once.

    Words with equal codes only make their phrases candidates together.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Codes()
        for batch in batches:
            codes = [np.fromiter(map(known.__getitem__, words_and_breaks(t)), dtype=np.uint32).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([c + END if c else c for c in codes], pa.binary()), batch.column(1), batch.column(2)],
                                             ["codes", "lang", "shard"])

    return staged(shares.mapInArrow(encode, "codes binary, lang string, shard int"), "codes")


def mined(codes: DataFrame, n: int, parts: Bitmap | None, least: int) -> DataFrame:
    """(key): the phrases of ``n`` words that a shard holds ``least`` times; ``parts`` are those of n - 1 words."""
    seen = codes.sparkSession.sparkContext.broadcast(parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for coded, langs, shards in _chunks(batches):
            lengths = [len(c) // 4 for c in coded]
            shard = np.repeat(np.array(shards, dtype=np.uint8), lengths)
            before = None
            for level, keys, valid in _levels(np.frombuffer(b"".join(coded), dtype=np.uint32), list(zip(lengths, langs))):
                if level >= n - 1:
                    keys |= shard[:len(keys)]
                if level == n:
                    break
                before = keys
            at = np.nonzero(valid)[0]
            if n > 1:
                held = seen.value.holds(before)
                at = at[held[at] & held[at + 1]]
            found, counts = np.unique(keys[at], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["key", "n"])

    rows = codes.mapInArrow(count, "key bigint, n bigint")
    return staged(rows.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), f"mined-{n}")


def counted(shares: DataFrame, candidates: Bitmap, least: int) -> DataFrame:
    """(lang, phrase, words, f): exact counts of all candidates found ``least`` times; words = 0 holds all words of a language."""
    seen = shares.sparkSession.sparkContext.broadcast(candidates)
    names = ["lang", "phrase", "words", "f"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs, _ in _chunks(batches):
            # the words of this chunk, numbered; 0 is a break
            ids: defaultdict = defaultdict()
            ids.default_factory = ids.__len__
            ids[BREAK]
            parts = [np.fromiter(map(ids.__getitem__, words_and_breaks(t) + [BREAK]), dtype=np.int32) for t in texts]
            lengths = [len(p) for p in parts]
            tokens, vocabulary = np.concatenate(parts), list(ids)
            del parts, texts, ids
            known = np.fromiter((0 if w == BREAK else xxhash.xxh32_intdigest(w) or 1 for w in vocabulary), dtype=np.uint32)
            ends = np.cumsum(lengths)
            before, alike = None, None
            for n, keys, valid in _levels(known[tokens], list(zip(lengths, langs))):
                if n == 1:
                    sizes = np.add.reduceat(valid, np.append(0, ends[:-1]), dtype=np.int64)
                    total: dict[str, int] = defaultdict(int)
                    for lang, size in zip(langs, sizes.tolist()):
                        total[lang] += size
                    yield _rows(names, list(total), [None] * len(total), 0, list(total.values()))
                    numbers = {lang: i for i, lang in enumerate(total)}
                    alike = np.repeat(np.array([numbers[lang] for lang in langs], dtype=np.int64), lengths)
                # a phrase is looked for only where both its parts were found
                held = np.zeros(len(keys), dtype=bool)
                at = np.nonzero(valid if before is None else valid & before[:-1] & before[1:])[0]
                held[at] = seen.value.holds(keys[at])
                before, at = held, np.nonzero(held)[0]
                if n == 1:
                    alike = alike * len(vocabulary) + tokens
                    counts = np.bincount(alike[at])
                    first = np.zeros(len(counts), dtype=np.int64)
                    first[alike[at]] = at
                    places, counts = first[counts > 0], counts[counts > 0]
                else:
                    # equal are phrases of one language with equal words, not just with equal keys
                    exact = alike[at] << 32 | tokens[at + n - 1]
                    _, first, same, counts = np.unique(exact, return_index=True, return_inverse=True, return_counts=True)
                    alike = np.zeros(len(keys), dtype=np.int64)
                    alike[at] = same
                    places = at[first]
                spoken = np.searchsorted(ends, places, side="right").tolist()
                for a in range(0, len(places), 100_000):
                    columns = [tokens[places[a:a + 100_000] + k].tolist() for k in range(n)]
                    phrases = [b" ".join([vocabulary[i] for i in ids]).decode("utf-8", "replace") for ids in zip(*columns)]
                    yield _rows(names, [langs[d] for d in spoken[a:a + 100_000]], phrases, n, counts[a:a + 100_000])

    rows = shares.mapInArrow(count, "lang string, phrase string, words int, f bigint")
    summed = rows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return staged(summed.where((F.col("f") >= least) | (F.col("words") == 0)), "phrases")


def _rows(names: list[str], langs: list, phrases: list, n: int, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()),
                                       pa.array(np.full(len(langs), n, dtype=np.int32)), pa.array(counts, pa.int64())], names)


def frequent_phrases(docs: DataFrame, support: int = 30, shards: int = 3, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, words, f) of all phrases of up to four words found ``support`` times in their language."""
    shares = _shares(docs, lang_col, text_col, shards)
    codes = encoded(shares)
    least = -(-support // shards)
    found, parts = [], None
    for n in range(1, LONGEST + 1):
        level = mined(codes, n, parts, least)
        found.append(level)
        if n < LONGEST:
            parts = bitmap_of(level)
    union = found[0]
    for level in found[1:]:
        union = union.union(level)
    return counted(shares, bitmap_of(union.select((F.col("key").bitwiseAND(F.lit(~SHARD_MASK))).alias("key")).distinct()), support)


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, k, score): each phrase of two words or more at its lowest-scoring cut."""
    phrases = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    cut = phrases.withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cut = cut.select("lang", "phrase", "words", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("head"),
                     F.expr("array_join(slice(w, k + 1, words - k), ' ')").alias("tail"))
    parts = counts.where(f"words between 1 and {LONGEST - 1}")
    both = (cut.join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    score = F.expr("(cast(2000000 as decimal(7, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "cut.*")


def collocations(docs: DataFrame, support: int = 30, top: int | None = 2000, shards: int = 3, inside: int = 80,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases (all: None).

    A phrase goes if a longer one that holds it has at least ``inside`` per cent of its count.
    """
    counts = frequent_phrases(docs, support, shards, lang_col, text_col)
    inner = F.expr("""filter(flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1),
                      i -> array_join(slice(split(phrase, ' '), i, m), ' ')))), p -> p <> phrase)""")
    covers = (counts.where("words >= 3").select("lang", F.explode(inner).alias("phrase"), "f")
              .groupBy("lang", "phrase").agg(F.max("f").alias("cover")))
    kept = (scored(counts).join(covers, ["lang", "phrase"], "left")
            .where(f"cover is null or cast(100 as decimal(20, 0)) * cover < cast({inside} as decimal(20, 0)) * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
