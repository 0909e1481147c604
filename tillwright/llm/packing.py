"""Packing of examples into sequences by vector bin packing.

A sequence has three capacities at once: tokens, segments and loss-bearing tokens. The next
example is the one whose demands have the largest dot product with what is left of the open
sequence, both as shares of the capacity. Where examples may be cut and none fits whole,
the best one is cut to what is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.library_ids import word_ids

WINDOW = 1024

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
PLACED = "example_id long, tokens long, loss_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4096


@dataclass
class Piece:
    item: int
    start: int
    length: int


class Packer:
    """Packs items as they come, from a window of at most ``window`` waiting items."""

    def __init__(self, limits: Limits, cut: bool, window: int = WINDOW):
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], np.float64)
        self.cut, self.window = cut, window
        self.items = np.empty(0, np.int64)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty((0, 3))
        self.open: list[Piece] = []
        self.left = self.capacity.copy()

    def add(self, items: np.ndarray, tokens: np.ndarray, loss: np.ndarray) -> Iterator[list[Piece]]:
        """Take items in and yield the sequences that are full."""
        for at in range(0, len(items), self.window):
            part = slice(at, at + self.window)
            sizes = np.stack([tokens[part], np.ones(len(tokens[part])), loss[part]], axis=1)
            self.items = np.concatenate((self.items, items[part]))
            self.starts = np.concatenate((self.starts, np.zeros(len(sizes), np.int64)))
            self.sizes = np.concatenate((self.sizes, sizes))
            if len(self.items) > self.window:
                yield from self._pack(self.window // 2)

    def finish(self) -> Iterator[list[Piece]]:
        yield from self._pack(0)
        if self.open:
            yield self._close()

    def _close(self) -> list[Piece]:
        made, self.open, self.left = self.open, [], self.capacity.copy()
        return made

    def _pack(self, keep: int) -> Iterator[list[Piece]]:
        while len(self.items) > keep:
            shares = (self.sizes / self.capacity) @ (self.left / self.capacity)
            fits = (self.sizes <= self.left).all(axis=1)
            if fits.any():
                i = int(np.where(fits, shares, -1.0).argmax())
                self._place(i, int(self.sizes[i, 0]))
            elif self.cut and self.left.min() >= 1:
                self._place(int(shares.argmax()), int(min(self.left[0], self.left[2])))
            elif self.open:
                yield self._close()
            else:
                # Larger than an empty sequence and not to be cut: a sequence of its own.
                i = int(shares.argmax())
                self._place(i, int(self.sizes[i, 0]))
                yield self._close()
                continue
            if self.left.min() < 1:
                yield self._close()

    def _place(self, i: int, length: int) -> None:
        self.open.append(Piece(int(self.items[i]), int(self.starts[i]), length))
        whole = length == self.sizes[i, 0]
        self.left -= self.sizes[i] if whole else (length, 1, length)
        if whole:
            last = len(self.items) - 1
            for name in ("items", "starts", "sizes"):
                column = getattr(self, name)
                column[i] = column[last]
                setattr(self, name, column[:last])
        else:
            self.starts[i] += length
            self.sizes[i, 0] -= length
            self.sizes[i, 2] -= length


def powers_of_two(pieces: list[Piece], capacity: int) -> Iterator[list[Piece]]:
    """A sequence that is not full as sequences of falling powers of two, which need no
    padding; a full one as it is."""
    total = sum(piece.length for piece in pieces)
    if total == capacity:
        yield pieces
        return
    room, made = 0, []
    for piece in pieces:
        start, length = piece.start, piece.length
        while length:
            if not room:
                room = 1 << (total.bit_length() - 1)
            take = min(room, length)
            made.append(Piece(piece.item, start, take))
            start, length, room, total = start + take, length - take, room - take, total - take
            if not room:
                yield made
                made = []


def pack_examples(
    df: DataFrame,
    id_col: str,
    tokens_col: str,
    loss_col: str,
    limits: Limits = Limits(),
    window: int = WINDOW,
) -> DataFrame:
    """``example_id, tokens, loss_tokens, sequence_id, offset`` of whole, uncut examples.

    No sequence exceeds a limit, except that an example larger than a limit has a sequence
    of its own. Null or negative sizes count as 0. Ids may be null or repeated: every row
    is placed once. Other columns are not read. Tasks pack their own rows from a bounded
    window, so nothing is shuffled; sequence ids are unique over all tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        packer, waiting, seen = Packer(limits, cut=False, window=window), {}, 0

        def emit(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for pieces in sequences:
                offset = 0
                for piece in pieces:
                    own, tokens, loss = waiting.pop(piece.item)
                    rows.append((own, tokens, loss, number, offset))
                    offset += tokens
                number += 1
            if rows:
                names = [part.split()[0] for part in PLACED.split(", ")]
                columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            ids, tokens, loss = (batch.column(i).to_pylist() for i in range(3))
            items = np.arange(seen, seen + len(ids))
            seen += len(ids)
            waiting.update(zip(items.tolist(), zip(ids, tokens, loss, strict=True), strict=True))
            yield from emit(packer.add(items, np.array(tokens, float), np.array(loss, float)))
        yield from emit(packer.finish())

    size = lambda name: F.greatest(F.coalesce(F.col(name).cast("long"), F.lit(0)), F.lit(0))
    rows = df.select(F.col(id_col).cast("long"), size(tokens_col), size(loss_col))
    return rows.mapInArrow(run, PLACED)


def pack_documents(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of the pieces
    of all documents, each document followed by ``end_id``.

    Documents may be cut. Parts as long as a sequence are sequences of their own; the rest
    is packed, and the last sequence of a task is cut into powers of two, so that nothing
    is padded. A null text is empty and has one piece of one id. Null and repeated ids keep
    their rows; an empty table gives an empty result. Every token bears loss.

    Tasks tokenise and pack their own rows from a bounded window and need no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids_of = word_ids(tokenizer_path, False, "<u2")
        end = np.array([end_id], "<u2").tobytes()
        packer, seen = Packer(limits, cut=True, window=window), 0
        # By item: document, its ids, and how many of them are not yet out.
        waiting: dict[int, list] = {}
        # No piece is longer than what a sequence takes of either kind of token.
        longest = min(limits.tokens, limits.loss_tokens)

        def emit(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for full in sequences:
                for pieces in powers_of_two(full, limits.tokens):
                    offset = 0
                    for piece in pieces:
                        own = waiting[piece.item]
                        ids = np.frombuffer(own[1], "<u2")
                        begin = own[3] + piece.start
                        part = ids[begin : begin + piece.length].astype("<u4")
                        rows.append((own[0], begin, piece.length, zlib.crc32(part.tobytes()), len(ids), number, offset))
                        offset += piece.length
                        own[2] -= piece.length
                        if not own[2]:
                            del waiting[piece.item]
                    number += 1
            if rows:
                names = [part.split()[0] for part in PIECES.split(", ")]
                columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            documents = batch.column(0).to_pylist()
            texts = [text or "" for text in batch.column(1).to_pylist()]
            items, rests = [], []
            for document, ids in zip(documents, ids_of.of(texts), strict=True):
                ids += end
                count = len(ids) // 2
                whole = count // longest * longest
                waiting[seen] = [document, ids, count, 0]
                if whole:
                    parts = range(0, whole, longest)
                    yield from emit([Piece(seen, at, longest)] for at in parts)
                if count > whole:
                    waiting[seen][3] = whole
                    items.append(seen), rests.append(count - whole)
                seen += 1
                if len(items) >= window:
                    sizes = np.array(rests, float)
                    yield from emit(packer.add(np.array(items), sizes, sizes))
                    items, rests = [], []
            if items:
                sizes = np.array(rests, float)
                yield from emit(packer.add(np.array(items), sizes, sizes))
        yield from emit(packer.finish())

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, PIECES)
