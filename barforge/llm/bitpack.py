"""Token-id files with fixed-width bit packing.

A file holds the ids of consecutive documents as one stream. Each id takes the
fewest bits that hold the largest id of the vocabulary; the stream is cut into
blocks of ``BLOCK`` ids whose byte offsets are stored, so any id is found by one
seek and a block is unpacked with numpy at once.

    magic "BPK1" | blocks | footer | length of the footer, 8 bytes | magic
    footer: JSON line {width, tokens, docs, blocks} and then the arrays
            block offsets u64, doc ids i64, null flags u8, token counts u64

Writing: documents are range-partitioned by id with cuts that depend on the rows
alone, sorted, encoded and written shard by shard below temporary names; the
committed manifest names the files and the number of ids before each.

Defined cases: null text counts as empty (only the end id); a null id sorts first
and comes back as null; rows that repeat an id are kept, ordered by their text; an
empty table gives an empty manifest. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import id_cuts, open_fs, shard_of
from barforge.llm.tokens import encoder

MAGIC = b"BPK1"
BLOCK = 1 << 16
MANIFEST_SCHEMA = "shard int, file string, docs bigint, tokens bigint, bytes bigint"
MAX_SHARDS = 1 << 16


def bit_width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids to ``width`` bits each, lowest bit first, padded to whole bytes."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{width // 8}", count=count).astype(np.uint32)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=count * width, bitorder="little")
    return bits.reshape(count, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


class Writer:
    """Streams documents into one file; memory holds one block and the document index."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.out.write(MAGIC)
        self.at, self.tokens, self.offsets = len(MAGIC), 0, []
        self.doc_ids, self.counts, self.waiting, self.parts = [], [], 0, []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.parts.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.parts), dtype="<u4")
        if len(ids) and int(ids.max()) >> self.width:
            raise ValueError(f"id {ids.max()} does not fit {self.width} bits")
        end = len(ids) if last else len(ids) // BLOCK * BLOCK
        for at in range(0, end, BLOCK):
            data = pack(ids[at:min(end, at + BLOCK)], self.width)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.tokens += end
        self.parts, self.waiting = [ids[end:].tobytes()], len(ids) - end

    def close(self) -> int:
        self._flush(True)
        null = np.array([d is None for d in self.doc_ids], dtype=np.uint8)
        head = {"width": self.width, "tokens": self.tokens, "docs": len(self.doc_ids), "blocks": len(self.offsets)}
        footer = json.dumps(head).encode() + b"\n" + b"".join([
            np.array(self.offsets, dtype="<u8").tobytes(),
            np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes(), null.tobytes(),
            np.array(self.counts, dtype="<u8").tobytes()])
        tail = footer + len(footer).to_bytes(8, "little") + MAGIC
        self.out.write(tail)
        self.out.close()
        return self.at + len(tail)


class Reader:
    """Random access to a packed file: ``ids(start, count)`` reads only the blocks it needs."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - 8 - len(MAGIC))
        tail = source.read(8 + len(MAGIC))
        if tail[8:] != MAGIC:
            raise ValueError("not a packed token file")
        length = int.from_bytes(tail[:8], "little")
        source.seek(size - 8 - len(MAGIC) - length)
        head, _, rest = source.read(length).partition(b"\n")
        head = json.loads(head)
        self.width, self.tokens, docs, blocks = head["width"], head["tokens"], head["docs"], head["blocks"]
        self.offsets = np.frombuffer(rest, "<u8", blocks)
        self.doc_ids = np.frombuffer(rest, "<i8", docs, 8 * blocks)
        self.null = np.frombuffer(rest, np.uint8, docs, 8 * (blocks + docs))
        self.counts = np.frombuffer(rest, "<u8", docs, 8 * (blocks + docs) + docs).astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        count = min(BLOCK, self.tokens - k * BLOCK)
        self.source.seek(int(self.offsets[k]))
        return unpack(self.source.read((count * self.width + 7) // 8), self.width, count)

    def ids(self, start: int, count: int) -> np.ndarray:
        parts, end = [], start + count
        for k in range(start // BLOCK, (end + BLOCK - 1) // BLOCK if count else start // BLOCK):
            block = self.block(k)
            parts.append(block[max(0, start - k * BLOCK):max(0, min(len(block), end - k * BLOCK))])
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc id, ids before it in the file, its ids, their crc32), reading each block once."""
        at, held, k = 0, b"", 0
        for doc, null, count in zip(self.doc_ids.tolist(), self.null.tolist(), self.counts.tolist()):
            crc, left = 0, 4 * count
            while left:
                if not held:
                    held, k = memoryview(self.block(k).astype("<u4").tobytes()), k + 1
                crc = zlib.crc32(held[:left], crc)
                left, held = left - min(left, len(held)), held[left:]
            yield (None if null else doc), at, count, crc
            at += count


def write_packed(docs: DataFrame, out: str, tokenizer: str, vocabulary: int, *, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", shard_bytes: int = 16 << 20) -> DataFrame:
    """Encode and write all documents below ``out``; returns the manifest with ``base``, the ids before each file.

    The manifest has a row per file (at most 65,536), so the running sum over it is small.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cuts = id_cuts(rows, "id", min(MAX_SHARDS, 1 + total // shard_bytes))
    width, end = bit_width(vocabulary), end_id.to_bytes(4, "little")
    sharded = (rows.withColumn("shard", shard_of(cuts, "id")).repartitionById(len(cuts) + 1, F.col("shard"))
               .sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "text").select("shard", "id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(out)
        encode, current, writer, temporary = encoder(tokenizer).encode, None, None, ""

        def finish() -> pa.RecordBatch:
            size, name = writer.close(), f"part-{current:06d}.bpk"
            store.move(temporary, posixpath.join(root, name))
            return pa.RecordBatch.from_pydict({
                "shard": pa.array([current], pa.int32()), "file": [name], "docs": [len(writer.doc_ids)],
                "tokens": [writer.tokens], "bytes": [size]})

        for batch in batches:
            for shard, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current:
                    if writer:
                        yield finish()
                    current, temporary = shard, posixpath.join(root, "_temporary", uuid.uuid4().hex)
                    store.create_dir(posixpath.dirname(temporary), recursive=True)
                    writer = Writer(store.open_output_stream(temporary, compression=None), width)
                writer.add(doc, encode(text) + end)
        if writer:
            yield finish()

    sharded.mapInArrow(write, MANIFEST_SCHEMA).write.parquet(f"{out}/_files")
    spark = docs.sparkSession
    files = spark.read.parquet(f"{out}/_files")
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files.withColumn("base", F.coalesce(before, F.lit(0))).write.parquet(f"{out}/_manifest")
    return spark.read.parquet(f"{out}/_manifest")


def read_packed(manifest: DataFrame, out: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) per document, from the files that the manifest lists."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(out)
        for batch in batches:
            for name, size, base in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(posixpath.join(root, name)) as source:
                    rows = list(Reader(source, size).documents())
                ids, at, counts, crcs = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.array(at, np.int64) + base), pa.array(counts, pa.int64()),
                     pa.array(crcs, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    files = manifest.select("file", "bytes", "base")
    return (files.repartition(max(1, files.count()), "file")
            .mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))
