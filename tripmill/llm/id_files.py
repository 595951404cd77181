"""Operator 1: token ids in binary files.

Ids are ranked by frequency over the whole corpus, so that frequent ids have
small numbers, and written in byte-aligned variable-length coding: a block is a
run of control bytes, two bits for each id's length of 1 to 4 bytes, and then the
significant bytes of all ids. Decoding looks up four lengths for each control
byte in a table and gathers the bytes with numpy.

A file holds whole documents in ascending order, at most ``shard_ids`` ids but
for a single longer document::

    magic "TMIDS001", u64 documents, u64 blocks
    i64 doc_id for each document, u8 null flag for each, u64 number of ids for each
    for each block: u64 ids, u64 data bytes, control bytes, data bytes

Defined cases: a null text is empty; an empty text is the end id alone; null ids
of documents come first; rows with the same id stay apart in any order; an empty
table gives no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.frames import (
    as_text,
    filesystem,
    group_count,
    keep,
    replacing,
    row_ids,
    workspace,
)
from tripmill.llm.tokens import encoded_batches

MAGIC = b"TMIDS001"
BLOCK_IDS = 1 << 16
#: Documents whose words are looked up together.
ROWS_AT_A_TIME = 2048
#: Lengths of the four ids that a control byte describes.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_BYTES_OF = _LENGTHS.sum(axis=1).astype(np.int64)


# Coding of one block


def encode_block(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    n = len(ranks)
    ranks = ranks.astype("<u4")
    code = (ranks > 0xFF).astype(np.uint8)
    code += ranks > 0xFFFF
    code += ranks > 0xFFFFFF
    padded = np.zeros(-(-n // 4) * 4, np.uint8)
    padded[:n] = code
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    in_use = np.arange(4, dtype=np.uint8) <= code[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[in_use].tobytes()


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4, dtype=np.uint8) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


# Files


def write_file(path: str, doc_ids: list[int | None], counts: list[int], ranks: np.ndarray) -> int:
    """Write whole documents; returns the size in bytes."""
    parts = [
        MAGIC,
        np.array([len(doc_ids), group_count(len(ranks), BLOCK_IDS)], "<u8").tobytes(),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        np.array(counts, "<u8").tobytes(),
    ]
    for at in range(0, max(1, len(ranks)), BLOCK_IDS):
        block = ranks[at : at + BLOCK_IDS]
        control, data = encode_block(block)
        parts += [np.array([len(block), len(data)], "<u8").tobytes(), control, data]
    with replacing(path) as out:
        for part in parts:
            out.write(part)
    return sum(map(len, parts))


def read_file(path: str) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids in each document, and all ranks of a file."""
    fs, name = filesystem(path)
    with fs.open_input_stream(name) as source:
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        documents, blocks = (int(x) for x in np.frombuffer(source.read(16), "<u8"))
        doc_ids = np.frombuffer(source.read(8 * documents), "<i8").tolist()
        nulls = np.frombuffer(source.read(documents), np.uint8).tolist()
        counts = np.frombuffer(source.read(8 * documents), "<u8").astype(np.int64)
        ranks = np.empty(int(counts.sum()), "<u4")
        at = 0
        for _ in range(blocks):
            n, size = (int(x) for x in np.frombuffer(source.read(16), "<u8"))
            control = source.read(-(-n // 4))
            ranks[at : at + n] = decode_block(control, source.read(size), n)
            at += n
    return [None if gone else x for x, gone in zip(doc_ids, nulls, strict=True)], counts, ranks


# Spark jobs

_IDS = "row long, doc_id long, n_tokens long, ids binary"
_FILES = "path string, shard int, part int, n_docs long, n_tokens long, n_bytes long"


def _dtype(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _tokenise(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, dtype: str
) -> Iterator[pa.RecordBatch]:
    seen = 0
    for part, encoded in encoded_batches(batches, path, end_id, rows=ROWS_AT_A_TIME):
        yield pa.record_batch({
            "row": row_ids(seen, part.num_rows),
            "doc_id": part.column("doc_id"),
            "n_tokens": pa.array([len(x) // 4 for x in encoded], pa.int64()),
            "ids": pa.array(
                [np.frombuffer(x, "<u4").astype(dtype).tobytes() for x in encoded], pa.binary()
            ),
        })
        seen += part.num_rows


def _count(batches: Iterator[pa.RecordBatch], dtype: str) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype)
        counts = np.bincount(ids, minlength=len(total))
        counts[: len(total)] += total
        total = counts
    ids = np.flatnonzero(total)
    yield pa.record_batch({"id": pa.array(ids, pa.int64()), "n": pa.array(total[ids], pa.int64())})


def token_counts(ids: DataFrame, dtype: str) -> DataFrame:
    """``id, n`` over the whole corpus; each task sends one row an id at most."""
    counted = ids.select("ids").mapInArrow(partial(_count, dtype=dtype), "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, ranks: np.ndarray, dtype: str, shard_ids: int
) -> Iterator[pa.RecordBatch]:
    shard, part = TaskContext.get().partitionId(), 0
    docs: list[int | None] = []
    counts: list[int] = []
    held: list[np.ndarray] = []
    rows: list[tuple] = []

    def flush() -> None:
        nonlocal part
        path = f"{folder}/ids-{shard:06d}-{part:04d}.bin"
        size = write_file(path, docs, counts, np.concatenate(held))
        rows.append((path, shard, part, len(docs), sum(counts), size))
        part += 1
        docs.clear(), counts.clear(), held.clear()

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "ids"))
        for doc_id, ids in zip(*columns, strict=True):
            own = ranks[np.frombuffer(ids, dtype)]
            if docs and sum(counts) + len(own) > shard_ids:
                flush()
            docs.append(doc_id)
            counts.append(len(own))
            held.append(own)
    if docs:
        flush()
    names = ("path", "shard", "part", "n_docs", "n_tokens", "n_bytes")
    types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    yield pa.record_batch({
        name: pa.array([row[i] for row in rows], kind)
        for i, (name, kind) in enumerate(zip(names, types, strict=True))
    })


def _read(batches: Iterator[pa.RecordBatch], ids_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, starts = (batch.column(c).to_pylist() for c in ("path", "start"))
        for path, start in zip(paths, starts, strict=True):
            docs, counts, ranks = read_file(path)
            ids = ids_of[ranks]
            ends = np.cumsum(counts)
            begins = ends - counts
            yield pa.record_batch({
                "doc_id": pa.array(docs, pa.int64()),
                "start": pa.array(begins + start, pa.int64()),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_crc32": pa.array(
                    [zlib.crc32(ids[b:e].tobytes()) for b, e in zip(begins, ends, strict=True)],
                    pa.int64(),
                ),
            })


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    end_id: int,
    vocabulary: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    work: str | None = None,
    shard_ids: int = 1 << 23,
) -> tuple[DataFrame, np.ndarray]:
    """Tokenise ``docs`` into files below ``folder``.

    Returns the list of files and the id of each rank. The ranks are the only
    thing the driver holds: one number for each entry of the vocabulary.
    """
    spark = docs.sparkSession
    work = workspace(spark, work)
    dtype = _dtype(max(vocabulary, end_id + 1))
    encoded = as_text(docs, id_column, text_column).mapInArrow(
        partial(_tokenise, path=tokenizer_path, end_id=end_id, dtype=dtype), _IDS
    )
    ids = keep(encoded, work, "ids")
    counts = token_counts(ids, dtype).orderBy(F.desc("n"), "id").collect()
    total = sum(r["n"] for r in counts)
    ids_of = np.array([r["id"] for r in counts], "<u4")
    ranks = np.zeros(int(ids_of.max()) + 1 if len(ids_of) else 1, "<u4")
    ranks[ids_of] = np.arange(len(ids_of), dtype="<u4")
    tasks = max(group_count(total, shard_ids), spark.sparkContext.defaultParallelism)
    files = (
        ids.repartitionByRange(tasks, F.col("doc_id").asc_nulls_first(), "row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "row")
        .select("doc_id", "ids")
        .mapInArrow(
            partial(_write, folder=folder, ranks=ranks, dtype=dtype, shard_ids=shard_ids), _FILES
        )
    )
    return keep(files, work, "files"), ids_of


def read_token_files(files: DataFrame, ids_of: np.ndarray) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``start`` counts the ids of all earlier documents. Adding up the lengths of
    the files takes one row for each file.
    """
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    # The number of files is known from the folder's list, not from the documents.
    n = max(1, files.count())
    return (
        placed.select("path", "start")
        .repartition(n, "path")
        .mapInArrow(
            partial(_read, ids_of=ids_of),
            "doc_id long, start long, n_tokens long, ids_crc32 long",
        )
    )
