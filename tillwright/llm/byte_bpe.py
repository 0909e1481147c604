"""Byte-level BPE encoding and decoding of whole documents by a table of merge ranks."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillwright.llm.pretoken import pieces

CHARS_AT_ONCE = 1_000_000
CACHED_PIECES = 400_000
SHORT_PIECE = 48
NO_RANK = 1 << 60

ENCODED = "doc_id long, ids array<int>, piece_starts array<int>, piece_tokens array<int>"


def in_chunks(texts: list[str], most: int = CHARS_AT_ONCE) -> Iterator[slice]:
    """Slices of ``texts`` of about ``most`` characters each; a longer text is one slice."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= most:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _merge_short(raw: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    get, cuts = ranks.get, list(range(len(raw) + 1))
    pairs = [get(raw[i : i + 2], NO_RANK) for i in range(len(raw) - 1)]
    while pairs and (best := min(pairs)) != NO_RANK:
        i = pairs.index(best)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(raw[cuts[i] : cuts[i + 2]], NO_RANK)
        if i:
            pairs[i - 1] = get(raw[cuts[i - 1] : cuts[i + 1]], NO_RANK)
    return tuple(ranks[raw[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True))


def _merge_long(raw: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same merges from a heap over a linked list, for pieces of any length."""
    size = len(raw)
    parts = [raw[i : i + 1] for i in range(size)]
    follow, lead = list(range(1, size + 1)), list(range(-1, size - 1))
    heap: list[tuple[int, int, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and follow[i] < size:
            pair = parts[i] + parts[follow[i]]
            rank = ranks.get(pair)
            if rank is not None:
                heapq.heappush(heap, (rank, i, pair))

    for i in range(size - 1):
        offer(i)
    while heap:
        _, i, pair = heapq.heappop(heap)
        if not parts[i] or follow[i] >= size or parts[i] + parts[follow[i]] != pair:
            continue
        gone = follow[i]
        parts[i], parts[gone] = pair, b""
        follow[i] = follow[gone]
        if follow[i] < size:
            lead[follow[i]] = i
        offer(lead[i])
        offer(i)
    return tuple(ranks[part] for part in parts if part)


class Vocabulary(dict):
    """Ids by piece, filled as pieces come up and emptied when full."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            read = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in read}
        self.tokens = dict(zip(self.ranks.values(), self.ranks.keys(), strict=True))

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        if rank is not None:
            ids = (rank,)
        else:
            merge = _merge_short if len(raw) <= SHORT_PIECE else _merge_long
            ids = merge(raw, self.ranks)
        if len(self) >= CACHED_PIECES:
            self.clear()
        if len(raw) <= 256:
            self[piece] = ids
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def vocabulary(path: str) -> Vocabulary:
    """One table for each Python worker and path."""
    return Vocabulary(path)


def encoded(texts: list[str], vocab: Vocabulary) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """For each text its ids, the starts of its pieces and the ids in each piece."""
    for part in in_chunks(texts):
        cut, starts, first = pieces(texts[part])
        found = list(map(vocab.__getitem__, cut))
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            yield list(chain.from_iterable(found[a:b])), starts[a:b], sizes[a:b]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [text or "" for text in batch.column(1).to_pylist()]


def encode_documents(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, piece_starts, piece_tokens`` for every row.

    ``piece_starts`` are the codepoint offsets of the pieces in the text and
    ``piece_tokens`` their numbers of ids, so that any piece can be decoded alone. A null
    text counts as empty and has empty arrays; null and repeated ids are kept as they are;
    other columns are not read. ``ranks_path`` must be readable on every executor. Nothing
    is shuffled, and a lost task is simply run again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks_path)
        for batch in batches:
            texts = _texts(batch)
            for part in in_chunks(texts):
                rows = list(encoded(texts[part], vocab))
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[part.start : part.stop], *(pa.array([r[i] for r in rows], ints) for i in range(3))],
                    names=["doc_id", "ids", "piece_starts", "piece_tokens"],
                )

    return df.selectExpr(f"cast({id_col} AS long) AS doc_id", text_col).mapInArrow(run, ENCODED)


def decode_documents(encoded_df: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, decoded`` with the bytes of every encoded document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks_path)
        for batch in batches:
            raw = [vocab.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(raw, pa.binary())], names=["doc_id", "decoded"]
            )

    return encoded_df.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def map_encoded(
    df: DataFrame,
    ranks_path: str,
    finish: Callable[[list[int], Callable], tuple],
    schema: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every document and keep only what ``finish(ids, decode)`` makes of its ids.

    The ids stay in the Python worker, which saves moving them when only a digest is wanted.
    Rows are as in :func:`encode_documents`; ``schema`` names the columns after ``doc_id``.
    """
    names = ["doc_id", *(part.split()[0] for part in schema.split(", "))]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(ranks_path)
        for batch in batches:
            made = [finish(ids, vocab.decode) for ids, _, _ in encoded(_texts(batch), vocab)]
            columns = [pa.array([row[i] for row in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return df.selectExpr(f"cast({id_col} AS long) AS doc_id", text_col).mapInArrow(run, f"doc_id long, {schema}")


class _Decimals(dict):
    def __missing__(self, number: int) -> str:
        text = self[number] = str(number)
        return text


_DECIMAL = _Decimals()


def digests(ids: list[int], decode: Callable) -> tuple[int, str, str]:
    """Number of ids, and the SHA-256 of their decimal forms and of the decoded bytes."""
    decimal = " ".join(map(_DECIMAL.__getitem__, ids)).encode()
    return len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(decode(ids)).hexdigest()
