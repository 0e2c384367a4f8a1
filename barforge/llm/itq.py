"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, reranking.

A rotation is learnt on a bounded sample (``SAMPLE`` vectors, those with the smallest
hashes): take the principal axes, then alternate between the binary
codes and the rotation that brings the projections closest to them (Gong and
Lazebnik 2011); several such rotations from different starts make a code of more bits than
dimensions. Every vector is coded. Nothing is centred: bits then follow the
angle between the vectors themselves, the one the threshold is about, whatever mean
they have in common.

The code is cut into words of ``WORD`` bits, one table each (Norouzi et al. 2012). A table's buckets
are the first ``key`` bits of its word; a pair of one bucket is looked at if the rest of the word
differs by at most ``NEAR`` bits, then if the whole codes differ by no more bits than vectors at the threshold do (five
standard deviations), and only what is left is compared by the original vectors in double precision.
The key grows with the number of vectors, so that a bucket holds about ``BLOCK`` of them, and the number of tables with the
key, so that all but ``MISSED`` of the pairs at the threshold are expected in a bucket (``plan``). Larger buckets
are cut into blocks, and all pairs of their blocks compared. A pair that several tables find counts in the first.

Equal vectors are compared once, as a class. A task reports how many links each of
its vectors has and at most one edge per vector, never all pairs of a dense group.

Every vector is indexed; the recall of links depends on the codes (see the tests).
Vectors of different lengths are never linked; each length has rotations of its own.
Defined cases: null, empty or zero vectors and null or non-finite components have no
links; rows that repeat an id and
vector are separate vectors with equal results; null ids are kept; empty tables give
an empty result. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, comb, log, log2, pi, sqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from barforge.llm.common import staged
from barforge.llm.graph import Forest, connected_components

SAMPLE = 20_000
ROUNDS = 40
WORD = 16
NEAR = 2
LEAST_KEY = 4
BLOCK = 4096
MISSED = 1e-4
AXES = 256


class Plan(NamedTuple):
    """How the vectors of one length are searched: bits of a bucket's key, tables, bits by which codes may differ."""

    key: int
    tables: int
    radius: int


def plan(vectors: int, cosine: float) -> Plan:
    """Keys by the number of vectors, tables by the share of pairs at the threshold that one table brings together."""
    flip = acos(min(1.0, max(-1.0, cosine))) / pi
    key = min(WORD, max(LEAST_KEY, ceil(log2(max(vectors, 1) / BLOCK))))
    rest = WORD - key
    found = (1 - flip) ** key * sum(comb(rest, k) * flip**k * (1 - flip) ** (rest - k) for k in range(min(NEAR, rest) + 1))
    tables = 1 if found >= 1 - MISSED else ceil(log(MISSED) / log(1 - found))
    bits = tables * WORD
    return Plan(key, tables, ceil(bits * flip + 5 * sqrt(bits * flip * (1 - flip))))


class Rotation:
    """Projection of learnt codes: bit j of x is x @ axes[:, j] > 0."""

    def __init__(self, sample: np.ndarray, bits: int, rounds: int = ROUNDS, seed: int = 0):
        rng = np.random.default_rng(seed)
        _, _, axes = np.linalg.svd(sample.T @ sample)
        kept = axes[:AXES].T
        projected = sample @ kept
        turns = [self._turn(projected, rounds, rng) for _ in range(-(-bits // kept.shape[1]))]
        self.axes = np.hstack([kept @ t for t in turns])[:, :bits]

    @staticmethod
    def _turn(projected: np.ndarray, rounds: int, rng: np.random.Generator) -> np.ndarray:
        turn, _ = np.linalg.qr(rng.normal(size=(projected.shape[1],) * 2))
        for _ in range(rounds):
            codes = np.where(projected @ turn > 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(codes.T @ projected)
            turn = (u @ v).T
        return turn

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """A row of words per vector."""
        return np.packbits(vectors @ self.axes > 0, axis=1).view(">u2").astype(np.uint16)


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def classes_of(vectors: DataFrame) -> DataFrame:
    """(cls, dims, v, size, first_id): the distinct usable vectors."""
    return vectors.where("ok").groupBy("cls").agg(F.size(F.first("v")).alias("dims"), F.first("v").alias("v"),
                                                  F.count("*").alias("size"), F.min("id").alias("first_id"))


def learn(classes: DataFrame, cosine: float) -> dict[int, tuple[Plan, Rotation]]:
    """One fit per length, on its classes with the smallest hashes, at most ``SAMPLE`` of them."""
    out = {}
    for dims, n in classes.groupBy("dims").agg(F.count("*").alias("n")).where("n > 1").collect():
        rows = classes.where(F.col("dims") == dims).orderBy("cls").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
        sample = np.array(rows.values, dtype=np.float64).reshape(len(rows), -1)
        found = plan(n, cosine)
        out[dims] = found, Rotation(sample / np.linalg.norm(sample, axis=1)[:, None], found.tables * WORD)
    return out


def matrix(lists: pa.Array, dtype: type) -> np.ndarray:
    """Lists of one length as rows."""
    return np.asarray(lists.flatten(), dtype=dtype).reshape(len(lists), -1)


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1)[:, None]


def coded(classes: DataFrame, learnt: dict[int, tuple[Plan, Rotation]]) -> DataFrame:
    """Classes with their code, a list of words; a class that is the only one of its length has no partner and is left out."""
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = whole.column("dims").to_numpy()
            for dims in np.intersect1d(lengths, list(learnt)):
                batch = whole.filter(pa.array(lengths == dims))
                words = learnt[int(dims)][1].codes(unit(matrix(batch.column("v"), np.float64)))
                ends = np.arange(len(words) + 1, dtype=np.int32) * words.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(words.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["cls", "dims", "v", "size", "code"])

    kept = classes.select("cls", "dims", "v", "size")
    return kept.mapInArrow(code, f"cls bigint, dims int, v {kept.schema['v'].dataType.simpleString()}, size bigint, code array<int>")


def block_pairs(codes: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """(dims, t, a, b): the blocks of each bucket, ``b`` null, and the pairs of its blocks; a side: lists of class, size, code, vector."""
    shift = F.element_at(F.create_map(*[F.lit(x) for d, p in plans.items() for x in (d, WORD - p.key)]), F.col("dims"))
    spread = codes.select("*", F.posexplode("code").alias("t", "word")).withColumn("bucket", F.expr("word").bitwiseAND(F.lit(0xFFFF)))
    spread = spread.withColumn("bucket", F.floor(F.col("bucket") / F.pow(F.lit(2), shift)).cast("int")).drop("word")
    sizes = spread.groupBy("dims", "t", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    # about as many buckets as a table has vectors by BLOCK: joined by AQE's choice, not by a hint
    blocks = (spread.join(sizes, ["dims", "t", "bucket"])
              .groupBy("dims", "t", "bucket", "blocks", F.expr("pmod(hash(cls), blocks)").alias("block"))
              .agg(F.collect_list(F.struct("cls", "size", "code", "v")).alias("a")))
    blocks = staged(blocks, "hamming-tables")
    others = blocks.where("blocks > 1").select("dims", "t", "bucket", F.col("block").alias("other"), F.col("a").alias("b"))
    within = blocks.select("dims", "t", "a", F.lit(None).cast(blocks.schema["a"].dataType).alias("b"))
    across = blocks.where("blocks > 1").join(others, ["dims", "t", "bucket"]).where("block < other").select("dims", "t", "a", "b")
    return within.unionByName(across)


class Side(NamedTuple):
    cls: np.ndarray
    size: np.ndarray
    code: np.ndarray
    v: np.ndarray

    @classmethod
    def of(cls, rows: pa.StructScalar) -> Side:
        """One side of a block pair; its lists are read as whole arrays."""
        kinds = {"cls": np.int64, "size": np.int64}
        values = {name: np.asarray(rows.field(name), dtype=t) for name, t in kinds.items()}
        return cls(**values, code=matrix(rows.field("code"), np.uint16), v=unit(matrix(rows.field("v"), np.float64)))


def candidates(a: Side, b: Side, same: bool, t: int, how: Plan) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions that table ``t`` brings together first, by codes alone."""
    for at in range(0, len(a.cls), 256):
        words = a.code[at:at + 256, t][:, None] ^ b.code[:, t][None, :]
        i, j = np.nonzero(np.bitwise_count(words) <= NEAR)
        i += at
        if same:
            i, j = i[j > i], j[j > i]
        for part in range(0, len(i), 1 << 17):
            i_, j_ = i[part:part + (1 << 17)], j[part:part + (1 << 17)]
            differ = a.code[i_] ^ b.code[j_]
            bits = np.bitwise_count(differ)
            tables = (differ >> np.uint16(WORD - how.key) == 0) if how.key < WORD else differ == 0
            first = (tables & (bits <= NEAR)).argmax(axis=1) == t
            kept = first & (bits.sum(axis=1, dtype=np.int64) <= how.radius)
            yield i_[kept], j_[kept]


def compare(pairs: DataFrame, plans: dict[int, Plan], cosine: float) -> DataFrame:
    """(cls, other, n): ``n`` links of a class found in a task (other null), or an edge (n null)."""

    def found(a: Side, b: Side, same: bool, t: int, how: Plan) -> Iterator[pa.RecordBatch]:
        n_a, n_b = np.zeros(len(a.cls), np.int64), np.zeros(len(b.cls), np.int64)
        nodes = a.cls if same else np.concatenate((a.cls, b.cls))
        forest, shift = Forest(len(nodes)), 0 if same else len(a.cls)
        step = max(1, (1 << 22) // a.v.shape[1])
        for all_i, all_j in candidates(a, b, same, t, how):
            for part in range(0, len(all_i), step):
                i, j = all_i[part:part + step], all_j[part:part + step]
                linked = np.einsum("ij,ij->i", a.v[i], b.v[j]) >= cosine
                i, j = i[linked], j[linked]
                np.add.at(n_a, i, b.size[j])
                np.add.at(n_b, j, a.size[i])
                forest.link(i, j + shift)
        i, j = forest.edges()
        cls, n = np.concatenate((a.cls, b.cls)), np.concatenate((n_a, n_b))
        cls, n = cls[n > 0], n[n > 0]
        none = lambda size: pa.nulls(size, pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(cls), none(len(cls)), pa.array(n)], ["cls", "other", "n"])
        yield pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(nodes[j]), none(len(i))], ["cls", "other", "n"])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, tables = batch.column("dims").to_pylist(), batch.column("t").to_pylist()
            for k, (d, t) in enumerate(zip(dims, tables)):
                a, other = Side.of(batch.column("a")[k].values), batch.column("b")[k]
                b = Side.of(other.values) if other.is_valid else a
                yield from found(a, b, not other.is_valid, t, plans[d])

    return pairs.mapInArrow(links, "cls bigint, other bigint, n bigint")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """(id, n_links, component_id) per row of ``df``."""
    kind = df.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)  # carried as it is, computed with as doubles
    v = F.col(vector_col).cast("array<float>" if single else "array<double>")
    vectors = df.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"), F.xxhash64(v).alias("cls"), _usable(v).alias("ok"))
    classes = staged(classes_of(vectors), "vector-classes")
    learnt = learn(classes, cosine)
    plans = {dims: how for dims, (how, _) in learnt.items()}
    if not plans:  # no length has two vectors: nothing to compare
        found = classes.select("cls", F.col("cls").alias("other"), F.col("cls").alias("n")).where("false")
    else:
        found = staged(compare(block_pairs(coded(classes, learnt), plans), plans, cosine), "vector-links")
    counts = found.where("n is not null").groupBy("cls").agg(F.sum("n").alias("n"))
    components = connected_components(found.where("other is not null").select(F.col("cls").alias("src"), F.col("other").alias("dst")))
    known = (classes.select("cls", "size", "first_id").join(counts, "cls", "left")
             .join(components.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("component", F.coalesce("component", "cls")))
    first = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = known.join(first, "component").select(
        F.col("cls"), (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    out = vectors.withColumn("key", F.when(F.col("ok"), F.col("cls"))).join(known.withColumnRenamed("cls", "key"), "key", "left")
    return out.select("id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id"))

