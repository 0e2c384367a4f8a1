"""Source divergence audit: how each source's terms differ from its language's other sources.

In-mapper stripes: a task folds whole documents into one hash stripe per (language, term),
a map from source to document frequency and count, and emits the stripes when it holds
``STRIPE_ENTRIES`` entries and at its end. Spark merges them by key. A term's merged
stripe has all that its divergences need: the share of every source, so the terms of each
source and the sums of each pair of sources come from the stripes alone.

Shares are whole numbers, p = 1 + floor(10^9 (count + smooth) / (N + smooth V)). All sums
are exact: a share's digits come from a long division in three steps of a thousand.

The list of (language, source) groups goes to every task; the result holds a row for every
ordered pair of sources of a language, so that list is as the square root of the result.

Defined cases: null texts, languages and sources are empty strings; groups without any
term, and languages that keep none, still have their pairs, of value 0; rows that repeat a
document count again; a very long text is folded whole; an empty table gives no rows. Only
the three columns are read, whatever else there is.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import staged

STRIPE_ENTRIES = 2_000_000
ONE = 1 << 40  # a stripe's entry: documents * ONE + occurrences, in one task
SCALE = 1_000_000_000
BLOCK_CELLS = 1 << 21  # shares held at a time
SUM_CELLS = 1 << 23  # sums held at a time

#: all but letters and bytes beyond ASCII become blanks; A-Z become a-z
TABLE = bytes(c if c >= 0x80 else ord(chr(c).lower()) if chr(c) in string.ascii_letters else 0x20 for c in range(256))

STRIPE = "lang string, term string, counts array<struct<source: string, df: bigint, n: bigint>>"


def terms(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes: dict[str, dict[bytes, dict[str, int]]] = defaultdict(dict)
    entries = 0
    for batch in batches:
        for text, lang, source in zip(*(batch.column(c).to_pylist() for c in range(3))):
            of_lang = stripes[lang]
            for term, n in Counter(terms(text)).items():
                stripe = of_lang.get(term)
                if stripe is None:
                    of_lang[term] = {source: ONE + n}
                    entries += 1
                elif source in stripe:
                    stripe[source] += ONE + n
                else:
                    stripe[source] = ONE + n
                    entries += 1
            if entries >= STRIPE_ENTRIES:
                yield from _spilled(stripes)
                stripes.clear()
                entries = 0
    yield from _spilled(stripes)


def _spilled(stripes: dict[str, dict[bytes, dict[str, int]]]) -> Iterator[pa.RecordBatch]:
    for lang, of_lang in stripes.items():
        keys = list(of_lang)
        for at in range(0, len(keys), 50_000):
            part = keys[at:at + 50_000]
            maps = [of_lang[k] for k in part]
            sources = [s for m in maps for s in m]
            packed = np.array([v for m in maps for v in m.values()], dtype=np.int64)
            ends = np.cumsum([0] + [len(m) for m in maps]).astype(np.int32)
            entry = pa.StructArray.from_arrays([pa.array(sources, pa.string()), pa.array(packed // ONE), pa.array(packed % ONE)],
                                               ["source", "df", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part), pa.string()), pa.array([k.decode("utf-8", "replace") for k in part], pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends), entry)], ["lang", "term", "counts"])


def stripes(rows: DataFrame, least_docs: int = 30) -> DataFrame:
    """(lang, term, counts array<struct<source, n>>): the merged stripes of terms in ``least_docs`` documents of a language.

    A task sends a term at most once per spill, so no term is hot; counts are added one by one, not gathered first.
    """
    sent = rows.mapInArrow(_fold, STRIPE).repartition("lang", "term")
    one = sent.select("lang", "term", F.inline("counts")).groupBy("lang", "term", "source").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))
    merged = one.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return staged(merged.where(F.col("df") >= least_docs).select("lang", "term", "counts"), "stripes")


def share(count: str, total: str, smooth: int) -> Column:
    """1 + floor(10^9 (count + smooth) / total), in decimals."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({count} + {smooth} as decimal(20, 0))) div cast({total} as decimal(20, 0))")


def shares(counts: np.ndarray, totals: np.ndarray, smooth: int) -> np.ndarray:
    """The same for arrays: three digits of a thousand at a time, so that nothing passes 64 bits."""
    rest, out = counts + smooth, np.zeros(np.broadcast(counts, totals).shape, dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // totals
        rest = rest % totals
    return out + 1


def groups(rows: DataFrame, kept: DataFrame, smooth: int) -> DataFrame:
    """(lang, source, total, lang_total): the divisors N + smooth V of every group and of its language."""
    sums = kept.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    found = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(sizes, "lang", "left")
    of_lang = sums.groupBy("lang").agg(F.sum("n").alias("lang_n"))
    zero = F.lit(0).cast("bigint")
    found = found.join(of_lang, "lang", "left").select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"),
                                                       F.coalesce("lang_n", zero).alias("lang_n"))
    return staged(found.select("lang", "source", (F.col("n") + smooth * F.col("v")).alias("total"),
                               (F.col("lang_n") + smooth * F.col("v")).alias("lang_total")), "groups")


class _Sums:
    """Sums of |p - q| over terms for the pairs of sources of one language."""

    def __init__(self, lang: str, sources: list[str], totals: list[int], smooth: int):
        self.lang, self.sources, self.smooth = lang, sources, smooth
        self.place = {s: i for i, s in enumerate(sources)}
        self.totals = np.array(totals, dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.cells = np.zeros((len(self.sources), len(self.sources)), dtype=np.int64)
        self.used = False

    def add(self, counts: list[list[dict]]) -> None:
        rows = max(1, BLOCK_CELLS // len(self.sources))
        for at in range(0, len(counts), rows):
            part = counts[at:at + rows]
            block = np.zeros((len(part), len(self.sources)), dtype=np.int64)
            for row, stripe in enumerate(part):
                for entry in stripe:
                    block[row, self.place[entry["source"]]] = entry["n"]
            p = shares(block, self.totals, self.smooth)
            for a in range(len(self.sources) - 1):
                self.cells[a, a + 1:] += np.abs(p[:, a + 1:] - p[:, a:a + 1]).sum(axis=0)
        self.used = True

    def rows(self) -> Iterator[pa.RecordBatch]:
        names = np.array(self.sources, dtype=object)
        for a in range(len(names) - 1) if self.used else ():
            near, far = [self.sources[a]] * (len(names) - a - 1), names[a + 1:].tolist()
            value = self.cells[a, a + 1:]
            for left, right in ((near, far), (far, near)):
                yield pa.RecordBatch.from_arrays([pa.array([self.lang] * len(far), pa.string()), pa.array(left, pa.string()),
                                                  pa.array(right, pa.string()), pa.array(value)], ["lang", "source", "item", "value"])


def pair_values(kept: DataFrame, sized: DataFrame, smooth: int) -> DataFrame:
    """(lang, source, item, value): the summed differences of every two sources of a language with kept terms."""
    listed: dict[str, list] = defaultdict(list)
    for r in sized.select("lang", "source", "total").orderBy("lang", "source").collect():
        listed[r.lang].append((r.source, r.total))
    known = kept.sparkSession.sparkContext.broadcast(dict(listed))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, _Sums] = {}
        for batch in batches:
            of_lang: dict[str, list] = defaultdict(list)
            for lang, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of_lang[lang].append(counts)
            for lang, counts in of_lang.items():
                if lang not in sums:
                    if sum(s.cells.size for s in sums.values()) > SUM_CELLS:
                        for s in sums.values():
                            yield from s.rows()
                        sums.clear()
                    sums[lang] = _Sums(lang, *map(list, zip(*known.value[lang])), smooth)
                sums[lang].add(counts)
        for s in sums.values():
            yield from s.rows()

    found = kept.select("lang", "counts").mapInArrow(emit, "lang string, source string, item string, value bigint")
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    other = sized.select("lang", F.col("source").alias("item"))
    pairs = sized.select("lang", "source").join(other, "lang").where("source <> item")
    return pairs.join(found, ["lang", "source", "item"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0).cast("bigint")).alias("value"))


def term_values(kept: DataFrame, sized: DataFrame, smooth: int) -> DataFrame:
    """(lang, source, item, value): how far a source's share of a term lies above its language's."""
    spread = kept.select("lang", F.col("term").alias("item"), F.inline("counts"),
                         F.expr("aggregate(counts, 0L, (t, c) -> t + c.n)").alias("all_n"))
    value = share("n", "total", smooth) - share("all_n", "lang_total", smooth)
    return (spread.where("n > 0").join(sized, ["lang", "source"])
            .select("lang", "source", "item", value.alias("value")).where("value > 0"))


def source_divergences(docs: DataFrame, least_docs: int = 30, smooth: int = 5, top: int = 50, *, lang_col: str = "lang",
                       source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for all other sources, ``term`` rows to rank ``top``."""
    empty = F.lit("")
    rows = docs.select(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), empty).alias("lang"),
                       F.coalesce(F.col(source_col).cast("string"), empty).alias("source"))
    kept = stripes(rows, least_docs)
    sized = groups(rows, kept, smooth)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    pairs = pair_values(kept, sized, smooth).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    best = term_values(kept, sized, smooth).select("lang", "source", F.lit("term").alias("part"), "item", "value", rank)
    return pairs.union(best.where(F.col("rank") <= top))
