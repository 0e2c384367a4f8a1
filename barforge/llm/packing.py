"""Bounded-space online packing of tokenised documents into fixed-length sequences.

Each partition streams its documents once and keeps at most ``open_windows`` windows
open. A document longer than a window is cut into full windows and a rest. A piece
goes to the open window with the least room that holds it (best fit). When none
holds it and all windows are open, the fullest one is emitted; if that would leave
``min_cut`` tokens of padding or more, the piece is cut to fill it first.

The windows still open at the end of a partition are merged in rounds: groups of
``fan_in`` partitions' leftovers are packed again, largest piece first, and each
group passes on at most ``open_windows`` windows, until one group is left. A task
never holds more than ``fan_in * open_windows`` windows.

Only piece positions travel, not ids; ``keep_ids`` adds each piece's ids to the
rows. Token counts cover whole texts. Defined cases: a null text is an empty one and
gives the end id alone; rows that repeat an id are packed as separate documents;
null ids are kept; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import staged
from barforge.llm.tokens import encoder

PIECE = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
         ("doc_tokens", pa.int64()), ("ids", pa.binary())]
PLACED = [*PIECE, ("sequence_id", pa.int64()), ("offset", pa.int64()), ("part", pa.int64()), ("open", pa.bool_())]
PLACED_SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary, "
                 "sequence_id bigint, offset bigint, part bigint, open boolean")
ROUND_BITS, PART_BITS = 5, 26  # of a sequence id: round, task of the round, window of the task


@dataclass
class Window:
    number: int
    used: int = 0
    pieces: list[tuple] = field(default_factory=list)

    def put(self, piece: tuple) -> None:
        self.pieces.append((*piece, self.used))
        self.used += piece[2]


class Packer:
    """Best fit into at most ``limit`` open windows of ``size`` tokens (``limit`` 0: no bound)."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit, self.made = size, limit, 0
        self.rooms: list[tuple[int, int]] = []  # (room, number) of the open windows, ascending
        self.windows: dict[int, Window] = {}

    def fits(self, length: int) -> bool:
        return bisect_left(self.rooms, (length, -1)) < len(self.rooms)

    def full(self) -> bool:
        return bool(self.limit) and len(self.rooms) >= self.limit

    def least_room(self) -> int:
        return self.rooms[0][0]

    def place(self, piece: tuple) -> Window | None:
        """Put a piece into its best window, or a new one; returns the window if that fills it."""
        at = bisect_left(self.rooms, (piece[2], -1))
        if at < len(self.rooms):
            window = self.windows[self.rooms.pop(at)[1]]
        else:
            window = self.windows[self.made] = Window(self.made)
            self.made += 1
        window.put(piece)
        if window.used == self.size:
            return self.windows.pop(window.number)
        insort(self.rooms, (self.size - window.used, window.number))
        return None

    def emit_fullest(self) -> Window:
        return self.windows.pop(self.rooms.pop(0)[1])

    def rest(self) -> list[Window]:
        """What is still open, fullest first."""
        return [self.windows[number] for _, number in self.rooms]


def _pieces(doc_id: int | None, ids: bytes, start: int, end: int, keep_ids: bool) -> tuple:
    part = ids[4 * start:4 * end]
    return doc_id, start, end - start, zlib.crc32(part), len(ids) // 4, part if keep_ids else None


def pack_document(packer: Packer, doc_id: int | None, ids: bytes, min_cut: int, keep_ids: bool) -> Iterator[Window]:
    """Place one document's ids; yields the windows that this closes."""
    at, total, size = 0, len(ids) // 4, packer.size
    while total - at >= size:
        window = Window(packer.made)
        packer.made += 1
        window.put(_pieces(doc_id, ids, at, at + size, keep_ids))
        yield window
        at += size
    while at < total:
        left = total - at
        if not packer.fits(left) and packer.full():
            room = packer.least_room()
            if room >= min_cut:
                closed = packer.place(_pieces(doc_id, ids, at, at + room, keep_ids))
                at += room
                yield closed
            else:
                yield packer.emit_fullest()
            continue
        closed = packer.place(_pieces(doc_id, ids, at, total, keep_ids))
        if closed:
            yield closed
        return


def _columns(windows: list[Window], level: int, task: int, is_open: bool) -> dict[str, list]:
    rows = [(*piece[:6], ((level << PART_BITS) + task << 63 - ROUND_BITS - PART_BITS) + w.number, piece[6], task, is_open)
            for w in windows for piece in w.pieces]
    return dict(zip([n for n, _ in PLACED], map(list, zip(*rows)))) if rows else {}


def _batch(windows: list[Window], level: int, task: int, is_open: bool) -> Iterator[pa.RecordBatch]:
    if windows:
        yield pa.RecordBatch.from_pydict(_columns(windows, level, task, is_open), schema=pa.schema(PLACED))


def pack_documents(docs: DataFrame, tokenizer: str, *, end_id: int = 1, size: int = 2048, open_windows: int = 64,
                   min_cut: int = 32, fan_in: int = 32, id_col: str = "doc_id", text_col: str = "text",
                   keep_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place in the document and place in its sequence."""
    end = end_id.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode, packer = TaskContext.get().partitionId(), encoder(tokenizer).encode, Packer(size, open_windows)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                closed = list(pack_document(packer, doc_id, encode(text or "") + end, min_cut, keep_ids))
                yield from _batch(closed, 0, task, False)
        yield from _batch(packer.rest(), 0, task, True)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    placed = staged(rows.mapInArrow(pack, PLACED_SCHEMA), "packed-0")
    return merge_leftovers(placed, size, open_windows, fan_in).drop("part", "open", *([] if keep_ids else ["ids"]))


def merge_leftovers(placed: DataFrame, size: int, open_windows: int, fan_in: int) -> DataFrame:
    """Pack the open windows of ever fewer groups again; every piece ends in a closed window."""
    done, level = placed.where("not open"), 0
    while True:
        left = placed.where("open")
        parts = left.select("part").distinct().count()
        if not parts:
            return done
        level += 1
        groups = -(-parts // fan_in)
        placed = staged(_merge_round(left, level, groups, size, open_windows if groups > 1 else 0), f"packed-{level}")
        done = done.union(placed.where("not open"))


def _merge_round(left: DataFrame, level: int, groups: int, size: int, keep_open: int) -> DataFrame:
    names = [n for n, _ in PLACED]

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "sequence_id", "offset"], ascending=[False, True, True])
        packer, closed = Packer(size, 0), []
        for piece in frame[names[:6]].astype(object).itertuples(index=False, name=None):
            closed += [w for w in [packer.place(piece)] if w]
        rest = packer.rest()
        keep = min(keep_open, len(rest))
        task = int(key[0])
        parts = [_columns(closed + rest[:len(rest) - keep], level, task, False),
                 _columns(rest[len(rest) - keep:], level, task, True)]
        rows = {n: sum((p.get(n, []) for p in parts), []) for n in names}
        return pd.DataFrame({n: pd.array(v, dtype="Int64") if n == "doc_id" else v for n, v in rows.items()})

    # consecutive numbers for the parts that have leftovers, so that groups are of equal size
    return (left.withColumn("grp", F.col("part") % groups).groupBy("grp")
            .applyInPandas(merge, PLACED_SCHEMA))


def sequences(pieces: DataFrame, size: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids array<bigint>): the packed rows, padded; needs ``keep_ids``.

    A sequence whose length is a power of two stays as long as it is.
    """

    def join(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(frame.sort_values("offset")["ids"]), "<u4").astype(np.int64)
        power = len(ids) & (len(ids) - 1) == 0
        full = ids if power else np.concatenate((ids, np.full(size - len(ids), pad_id, np.int64)))
        return pd.DataFrame({"sequence_id": [key[0]], "ids": [full]})

    return pieces.groupBy("sequence_id").applyInPandas(join, "sequence_id bigint, ids array<bigint>")
