"""Benchmark decontamination with a positional inverted index. DataFrame functions only.

The index holds the postings (term, document, position) of every benchmark term in
the documents, written once. Each benchmark window (``window`` consecutive words of
an item, or the whole of a shorter item) is looked up from its rarest term on: the
rarest term's postings, shifted by the term's place in the window, are the candidate
starts; each further list, in order of rising frequency, is intersected with them at
its own offset. After ``lists`` lists few false starts are left, and the words of the
documents that have any decide: a start is a match if all words agree.

``phrase_matches`` returns exact matches; ``near_matches`` the places where the rarest
terms of a window all occur within ``slop`` words of where the phrase would have them.

The benchmark's terms are broadcast only while there are at most
``BROADCAST_TERMS``; beyond that the join shuffles. Hot terms and hot documents are
left to Spark's skew join: no group is collected except one document's own matches.

Defined cases: null texts have no words; equal windows of one or several items are
looked up once; rows that repeat a document id are separate documents with equal
results; item and document ids may be null; empty tables give no matches. Only the
id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import ascii_lower, staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_TERMS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased words (letters, digits and all characters beyond ASCII)."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, window: int = 13, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(win, words, item_ids): each distinct window with the items that hold it. ``win`` is a hash of its words."""
    parted = items.select(F.col(id_col).cast("bigint").alias("item_id"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
    cut = F.expr(f"transform(sequence(0, greatest(0, size(w) - {window})), i -> slice(w, i + 1, {window}))")
    return (parted.select("item_id", F.explode(cut).alias("words"))
            .groupBy("words").agg(F.collect_set("item_id").alias("item_ids"), F.count("*").alias("rows"))
            .select(F.xxhash64(F.array_join("words", " ")).alias("win"), "words", "item_ids"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, row_id, pos) of ``terms`` (hashes) in ``docs`` (row_id, text), written to the shared folder."""
    spread = docs.select("row_id", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    spread = spread.select(F.xxhash64("word").alias("term"), "row_id", "pos")
    if terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS:
        terms = F.broadcast(terms)
    return staged(spread.join(terms, "term", "left_semi"), "postings")


def ranked_terms(windows: DataFrame, index: DataFrame, lists: int) -> DataFrame:
    """(win, term, off, rank): the ``lists`` rarest terms of each window, by their number of postings.

    A term that a window repeats counts at its first place.
    """
    spread = windows.select("win", F.posexplode("words").alias("off", "word")).select("win", "off", F.xxhash64("word").alias("term"))
    spread = spread.groupBy("win", "term").agg(F.min("off").alias("off"))
    seen = index.groupBy("term").agg(F.count("*").alias("postings"))
    order = Window.partitionBy("win").orderBy(F.coalesce("postings", F.lit(0)), "off")
    ranked = spread.join(seen, "term", "left").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= lists)
    return staged(ranked.select("win", "term", "off", "rank"), "ranked-terms")


def candidate_starts(windows: DataFrame, index: DataFrame, lists: int = 3, slop: int = 0) -> DataFrame:
    """(win, row_id, start): starts at which the rarest terms of the window are all in place, give or take ``slop``."""
    ranked = ranked_terms(windows, index, lists)

    def nth(k: int) -> DataFrame:
        return ranked.where(F.col("rank") == k).select("win", "term", "off")

    def postings(k: int) -> DataFrame:
        """The k-th terms' lists alone: what the index holds of other terms is not shuffled."""
        terms = nth(k).select("term").distinct()
        small = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
        return index.join(F.broadcast(terms) if small else terms, "term", "left_semi")

    found = (postings(1).join(nth(1), "term").select("win", "row_id", (F.col("pos") - F.col("off")).alias("start"))
             .where(F.col("start") >= -slop))
    for k in range(2, lists + 1):
        shifts = F.explode(F.array(*[F.lit(s) for s in range(-slop, slop + 1)]))
        wanted = found.join(nth(k), "win", "left")
        wanted = (wanted.withColumn("shift", shifts) if slop else wanted.withColumn("shift", F.lit(0)))
        wanted = wanted.withColumn("pos", F.col("start") + F.col("off") + F.col("shift"))
        # windows with fewer distinct terms than lists have no k-th one and stay
        hit = wanted.where("term is not null").join(postings(k), ["term", "row_id", "pos"], "left_semi")
        found = hit.select("win", "row_id", "start").union(wanted.where("term is null").select("win", "row_id", "start"))
        found = found.distinct() if slop else found
    return found


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row_id, doc_id, text) where row_id tells apart rows: equal rows share it, and their result."""
    doc, text = F.col(id_col).cast("bigint"), F.col(text_col).cast("string")
    return docs.select(F.xxhash64(doc, text).alias("row_id"), doc.alias("doc_id"), text.alias("text"))


def phrase_matches(docs: DataFrame, windows: DataFrame, lists: int = 3) -> DataFrame:
    """(row_id, n_words, starts array<struct<start, length>>, item_ids): documents (row_id, text) with any match."""
    index = build_index(docs, windows.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term")).distinct())
    starts = staged(candidate_starts(windows, index, lists).distinct(), "candidate-starts")
    # one row per document and window: where it may start
    asked = starts.groupBy("row_id", "win").agg(F.collect_list("start").alias("starts"))
    asked = asked.join(windows, "win").groupBy("row_id").agg(
        F.collect_list(F.struct("starts", "words", "item_ids")).alias("asked"))
    texts = docs.select("row_id", "text").join(asked.select("row_id"), "row_id", "left_semi").distinct()
    joined = texts.select("row_id", words(F.col("text")).alias("w")).join(asked, "row_id")
    exact = F.transform("asked", lambda a: F.struct(
        F.filter(a["starts"], lambda s: F.slice("w", s + 1, F.size(a["words"])) == a["words"]).alias("starts"),
        F.size(a["words"]).alias("length"), a["item_ids"].alias("item_ids")))
    kept = joined.select("row_id", F.filter(exact, lambda a: F.size(a["starts"]) > 0).alias("m")).where("size(m) > 0")
    return kept.select("row_id", F.flatten(F.transform("m", lambda a: F.transform(
        a["starts"], lambda s: F.struct(s.alias("start"), a["length"].alias("length"))))).alias("starts"),
        F.array_distinct(F.flatten(F.transform("m", lambda a: a["item_ids"]))).alias("item_ids"))


def near_matches(docs: DataFrame, windows: DataFrame, slop: int = 2, lists: int = 3) -> DataFrame:
    """(row_id, win, start): proximity matches, from the index alone."""
    index = build_index(docs, windows.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term")).distinct())
    return candidate_starts(windows, index, lists, slop).distinct()


def covered(starts: Column) -> Column:
    """Number of words inside any of the (start, length) ranges."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end"))

    def step(acc: Column, s: Column) -> Column:
        end = (s["start"] + s["length"]).cast("bigint")
        new = F.greatest(F.lit(0).cast("bigint"), end - F.greatest(acc["end"], s["start"].cast("bigint")))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(starts), zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, lists: int = 3, share: int = 20, *,
                  id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: row_id, doc_id, n_words, n_hit, item_ids, contaminated (at least 1 / ``share`` of words hit)."""
    windows = staged(item_windows(items, window, item_id_col, item_text_col), "windows")
    rows = numbered(docs, id_col, text_col)
    found = phrase_matches(rows, windows, lists).select("row_id", covered(F.col("starts")).alias("n_hit"), "item_ids")
    sized = rows.select("row_id", "doc_id", F.size(words(F.col("text"))).cast("bigint").alias("n_words"))
    out = sized.join(found, "row_id", "left").select(
        "row_id", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"))
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 and {share} * n_hit >= n_words"))
