"""Deterministic sharded WARC writer and reader.

``write_warc`` range-partitions records by id (cuts depend on the rows alone),
sorts each shard, regenerates every header and digest, compresses each record as
its own gzip member and rolls to a new file when the compressed size would pass
``file_bytes``. A task writes below a temporary name and moves the finished file to
its final name, so an attempt that is lost or runs twice leaves the same bytes
under the same name. The manifest, a Parquet table that Spark commits at the end,
lists the files that count; anything else in the folder is ignored.

Records with equal payloads of at least ``revisit_bytes`` bytes: the one with the
largest id is the response, the others are revisits that refer to it.

Defined cases: a null payload is an empty one; a null id sorts first, gets the
record id ``<urn:record:null>``, is never the response of a group that has ids, and
comes back as null; rows that repeat an id and its payload give one response and
revisits of it; a null url is an empty target; an empty table gives an empty
manifest. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import id_cuts, open_fs, shard_of

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "file string, shard int, seq int, records bigint, bytes bigint, sha256 string"
RECORD_SCHEMA = ("id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
                 "refers_to bigint, payload binary")
MAX_SHARDS = 1 << 16


def _digest_header(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_uri(record_id: int | None) -> str:
    return f"<urn:record:{'null' if record_id is None else record_id}>"


def _uri_id(uri: str) -> int | None:
    text = uri.removeprefix("<urn:record:").removesuffix(">")
    return None if text == "null" else int(text)


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)  # gzip without a time stamp
    return gz.compress(head.encode() + block + b"\r\n\r\n") + gz.flush()


def _uri_headers(url: str | None) -> list[tuple[str, str]]:
    """A header value cannot hold line breaks or outer blanks: such a url is percent-encoded and marked."""
    if url is None:
        return []
    if url == url.strip() and url.isprintable():
        return [("WARC-Target-URI", url)]
    return [("WARC-Target-URI", quote(url, safe="")), ("X-Target-URI-Quoted", "yes")]


def record_member(record_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                  is_revisit: bool, date: str, level: int) -> bytes:
    """One gzip member: a response with its HTTP block, or a revisit without payload."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    block = http.encode() if is_revisit else http.encode() + payload
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", _record_uri(record_id)),
        ("WARC-Date", date), *_uri_headers(url), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _digest_header(digest)), ("WARC-Block-Digest", _digest_header(hashlib.sha1(block).hexdigest())),
    ]
    if is_revisit:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", _record_uri(refers_to))]
    return _member(headers, block, level)


@dataclass
class _ShardFiles:
    """The files of one shard, one open at a time."""

    store: pafs.FileSystem
    root: str
    shard: int
    file_bytes: int
    level: int
    date: str
    done: list[dict] = field(default_factory=list)
    out: pa.NativeFile | None = None

    def add(self, member: bytes) -> None:
        if self.out and self.size + len(member) > self.file_bytes:
            self.close()
        if not self.out:
            self.temporary = posixpath.join(self.root, "_temporary", f"{self.shard}-{uuid.uuid4().hex}")
            self.store.create_dir(posixpath.dirname(self.temporary), recursive=True)
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sha = 0, 0, hashlib.sha256()
            info = b"software: barforge\r\nformat: WARC File Format 1.1\r\n"
            self._put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:warcinfo:{self.shard}:{len(self.done)}>"),
                               ("WARC-Date", self.date), ("Content-Type", "application/warc-fields")], info, self.level))
        self._put(member)
        self.records += 1

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.out = None
            name = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.store.move(self.temporary, posixpath.join(self.root, name))
            self.done.append({"file": name, "shard": self.shard, "seq": len(self.done), "records": self.records,
                              "bytes": self.size, "sha256": self.sha.hexdigest()})


def write_warc(records: DataFrame, out: str, id_col: str, url_col: str, payload_col: str, *, revisit_bytes: int = 1000,
               shard_bytes: int = 16 << 20, file_bytes: int = 64 << 20, level: int = 6,
               date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write all rows below ``out``; returns the committed manifest (one row per file).

    Shards hold about ``shard_bytes`` of payload each, more beyond 65,536 shards.
    """
    rows = records.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    narrow = rows.select("id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"))
    total = narrow.agg(F.sum("n")).first()[0] or 0
    shards = min(MAX_SHARDS, 1 + total // shard_bytes)
    cuts = id_cuts(rows, "id", shards)

    large = narrow.where(F.col("n") >= revisit_bytes)
    copies = large.groupBy("digest").agg(F.max("id").alias("kept"), F.count("*").alias("n")).where("n > 1")
    # Only rows that become revisits need a decision; it meets its record in the sorted shard,
    # so payloads are shuffled once and never joined.
    revisits = (large.join(copies.select("digest", "kept"), "digest")
                .where("kept is not null and not (id <=> kept)").select("id", "digest", "kept").distinct())
    both = rows.select("id", F.sha1("payload").alias("digest"), F.lit(None).cast("bigint").alias("kept"),
                       F.lit(1).alias("is_record"), "url", "payload").union(
        revisits.select("id", "digest", "kept", F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("binary")))
    sorted_rows = (both.withColumn("shard", shard_of(cuts, "id")).repartitionById(len(cuts) + 1, F.col("shard"))
                   .sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "digest", "is_record",
                                         F.col("url").asc_nulls_first())
                   .select("shard", "id", "digest", "kept", "is_record", "url", "payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(out)
        files, decided, kept, last = None, None, None, None
        for batch in batches:
            for shard_no, rid, digest, decision, is_record, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
                if files is None or files.shard != shard_no:
                    if files:
                        files.close()
                        yield _manifest_batch(files.done)
                    files = _ShardFiles(store, root, shard_no, file_bytes, level, date)
                if not is_record:
                    decided, kept = (rid, digest), decision
                    continue
                repeat = (rid, digest) == last and len(payload) >= revisit_bytes
                revisit = decided == (rid, digest) or repeat
                refers_to = kept if decided == (rid, digest) else rid
                files.add(record_member(rid, url, payload, digest, refers_to, revisit, date, level))
                last = (rid, digest)
        if files:
            files.close()
            yield _manifest_batch(files.done)

    sorted_rows.mapInArrow(write, MANIFEST_SCHEMA).write.parquet(f"{out}/{MANIFEST}")
    return records.sparkSession.read.parquet(f"{out}/{MANIFEST}")


def _manifest_batch(done: list[dict]) -> pa.RecordBatch:
    kinds = [("file", pa.string()), ("shard", pa.int32()), ("seq", pa.int32()), ("records", pa.int64()),
             ("bytes", pa.int64()), ("sha256", pa.string())]
    return pa.RecordBatch.from_pylist(done, schema=pa.schema(kinds))


class _Gunzip:
    """Reads consecutive gzip members from a stream without holding the whole file."""

    def __init__(self, source: pa.NativeFile):
        self.source, self.left = source, b""

    def members(self) -> Iterator[bytes]:
        while self.left or (more := self.source.read(1 << 20)):
            data, self.left = self.left or more, b""
            gz, parts = zlib.decompressobj(31), []
            while True:
                parts.append(gz.decompress(data))
                if gz.eof:
                    self.left = gz.unused_data
                    break
                data = self.source.read(1 << 20)
                if not data:
                    raise ValueError("a gzip member is cut off")
            yield b"".join(parts)


def parse_member(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return headers, rest[:int(headers["Content-Length"])]


def read_warc(manifest: DataFrame, out: str, with_payload: bool = False) -> DataFrame:
    """One row per response or revisit record of the files that the manifest lists.

    Digests are computed again from what is read and must match the headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_fs(out)
        for batch in batches:
            for name, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, pending = 0, []
                with store.open_input_stream(posixpath.join(root, name), compression=None) as source:
                    for member in _Gunzip(source).members():
                        headers, block = parse_member(member)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        pending.append(_read_record(headers, block, with_payload))
                        found += 1
                        if len(pending) == 256:
                            yield _record_batch(pending)
                            pending = []
                if found != expected:
                    raise ValueError(f"{name} holds {found} records, its manifest row says {expected}")
                if pending:
                    yield _record_batch(pending)

    files = manifest.select("file", "records")
    return files.repartition(max(1, min(MAX_SHARDS, files.count())), "file").mapInArrow(read, RECORD_SCHEMA)


def _read_record(headers: dict[str, str], block: bytes, with_payload: bool) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = headers["WARC-Type"] == "revisit"
    length = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length:")).split(b":")[1])
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if _digest_header(hashlib.sha1(block).hexdigest()) != headers["WARC-Block-Digest"]:
        raise ValueError(f"block digest differs in {headers['WARC-Record-ID']}")
    if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != length):
        raise ValueError(f"payload digest differs in {headers['WARC-Record-ID']}")
    url = headers.get("WARC-Target-URI")
    return {"id": _uri_id(headers["WARC-Record-ID"]), "url": unquote(url) if "X-Target-URI-Quoted" in headers else url,
            "record_type": headers["WARC-Type"], "payload_bytes": length, "payload_digest": digest,
            "refers_to": _uri_id(headers["WARC-Refers-To"]) if revisit else None,
            "payload": payload if with_payload and not revisit else None}


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
             ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))
