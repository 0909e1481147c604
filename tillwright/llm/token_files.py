"""Documents as flat files of token ids with 64-bit offsets, written and read in place.

A shard is a pair of files: ``<name>.ids`` holds the ids of its documents, one after the
other, as little-endian unsigned integers of one width; ``<name>.idx`` holds a header, the
base of the shard (ids in all shards before it), then per document its id and its end
within the shard. Shards are in ascending order of document id.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import staged
from tillwright.llm.library_ids import word_ids
from tillwright.session import shared_folder

MAGIC = b"TOKIDX01"
WIDTHS = {2: "<u2", 4: "<u4"}

MANIFEST = "shard long, documents long, tokens long, name string"


def local_path(uri: str) -> str:
    """The path of a shared folder that is mounted on every machine."""
    parsed = urlparse(uri)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted folder, not {uri}")
    return parsed.path


def _write(path: str, chunks: Iterator[bytes]) -> None:
    with open(path, "wb") as out:
        for chunk in chunks:
            out.write(chunk)


def read_index(path: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Document ids, ends of documents in ids, and the bytes of an id; all mapped."""
    raw = np.memmap(path, np.uint8, "r")
    if bytes(raw[:8]) != MAGIC:
        raise ValueError(f"{path} is no token index")
    width, documents = np.frombuffer(raw[8:24], "<u8").tolist()
    body = raw[24 : 24 + 16 * documents].view("<i8")
    return body[:documents], body[documents:], width


def write_token_files(
    df: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int = 0,
    vocabulary: int = 1 << 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write every document to shards under ``folder``; return ``shard, base, documents,
    tokens, name`` of each shard.

    Ids are those of the tokenizer, with ``end_id`` after each document; two bytes each if
    ``vocabulary`` allows. A null text is empty and has only the end id. Repeated ids keep
    all their rows, in the order of their texts; null ids come first and are written as the
    smallest 64-bit integer. An empty table gives no shard. Other columns are not read.

    One range shuffle orders the documents; sizes of shards become bases by a prefix sum
    over the shards. A file is written under a name of its own by each attempt, and only
    the attempt that Spark takes puts its name into the manifest, so lost executors and
    repeated tasks leave whole files.
    """
    width = 2 if vocabulary <= 1 << 16 else 4
    place = local_path(folder)
    os.makedirs(place, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer_path, True, WIDTHS[width])
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        end = np.array([end_id], WIDTHS[width]).tobytes()
        documents, sizes = [], []

        def chunks() -> Iterator[bytes]:
            for batch in batches:
                documents.append(batch.column(0).fill_null(np.iinfo(np.int64).min).to_numpy())
                for ids in ids_of.of([text or "" for text in batch.column(1).to_pylist()]):
                    sizes.append(len(ids) // width + 1)
                    yield ids + end

        _write(os.path.join(place, f"{name}.ids"), chunks())
        if not sizes:
            os.remove(os.path.join(place, f"{name}.ids"))
            return
        ends = np.cumsum(np.array(sizes, "<i8"))
        header = MAGIC + np.array([width, len(ends)], "<u8").tobytes()
        body = [np.concatenate(documents).astype("<i8").tobytes(), ends.tobytes()]
        _write(os.path.join(place, f"{name}.idx"), iter([header, *body]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (shard, len(ends), int(ends[-1]), name)],
            names=["shard", "documents", "tokens", "name"],
        )

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = staged(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    # One row for each shard, so the prefix sum is short at any size.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base")
    return shards.select("shard", base, "documents", "tokens", "name")


def read_token_files(
    shards: DataFrame, folder: str, finish: Callable[[np.ndarray], int], column: str = "ids_crc32"
) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``finish(ids)`` for every document in the shards.

    Files are mapped, so a task holds the pages of one document at a time.
    """
    place = local_path(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                documents, ends, width = read_index(os.path.join(place, f"{name}.idx"))
                ids = np.memmap(os.path.join(place, f"{name}.ids"), WIDTHS[width], "r")
                starts = np.concatenate(([0], ends[:-1]))
                for at in range(0, len(ends), 10_000):
                    part = slice(at, at + 10_000)
                    spans = zip(starts[part].tolist(), ends[part].tolist(), strict=True)
                    made = [finish(ids[a:b]) for a, b in spans]
                    own = documents[part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own, pa.int64(), mask=own == np.iinfo(np.int64).min),
                            pa.array(starts[part] + base, pa.int64()),
                            pa.array(ends[part] - starts[part], pa.int64()),
                            pa.array(made, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", column],
                    )

    # A number of its own for each shard's task: by their few bytes all would be one task.
    named = shards.select("name", "base").repartition(max(1, shards.count()), "name")
    return named.mapInArrow(run, f"doc_id long, start long, n_tokens long, {column} long")


def crc32_of_ids(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_file_report(df: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write ``df`` to token files in the shared folder and describe what is read back."""
    folder = shared_folder(df.sparkSession, "token-files")
    shards = write_token_files(df, folder, tokenizer_path, end_id)
    return read_token_files(shards, folder, crc32_of_ids)
