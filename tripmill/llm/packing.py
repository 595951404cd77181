"""Operator 5: best-fit packing of token sequences, in a tree of rounds.

A document longer than a sequence is cut from its end, so that only its first
piece is shorter. Full pieces are sequences by themselves. The others are dealt
into groups of bounded size, each packed by best fit with the longest first; bins
that are nearly full are done, and the rest go to the next round as items that
are dealt and packed again. Rounds end when one group has packed everything or
no two bins were joined any more.

Defined cases: a null or empty text has the end id alone; rows with the same id
are packed one by one; an empty table gives no rows; ids may be null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.frames import as_text, group_count, keep, row_ids, workspace
from tripmill.llm.tokens import encoded_batches

_PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACES = "uid long, bin long, offset long, fill long"
_MAX_ROUNDS = 12


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` tokens; the first may be shorter."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *[(at, capacity) for at in range(first, n, capacity)]]


def best_fit(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each item, longest first, each into the fullest bin that takes it.

    ``room`` holds the open bins by free space and ``free`` a bit for each free
    space that some bin has, so finding a bin takes one shift.
    """
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, bins = 0, 0
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[i]
        fitting = free >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            bin_ = room[space].pop()
            if not room[space]:
                free &= ~(1 << space)
        else:
            space, bin_ = capacity, bins
            bins += 1
        places[i] = (bin_, capacity - space)
        left = space - size
        room[left].append(bin_)
        free |= 1 << left
    return places


def _cut_texts(
    batches: Iterator[pa.RecordBatch],
    path: str,
    end_id: int,
    capacity: int,
    kept_bytes: int | None,
) -> Iterator[pa.RecordBatch]:
    seen = 0
    for part, encoded in encoded_batches(batches, path, end_id, kept_bytes):
        doc_ids = part.column("doc_id").to_pylist()
        rows = [
            (doc_id, k, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]))
            for doc_id, ids in zip(doc_ids, encoded, strict=True)
            for k, (at, n) in enumerate(cut(len(ids) // 4, capacity))
        ]
        doc_id, piece, start, length, crc = zip(*rows, strict=True)
        yield pa.record_batch({
            "uid": row_ids(seen, len(rows)),
            "doc_id": pa.array(doc_id, pa.int64()),
            "piece": pa.array(piece, pa.int32()),
            "start": pa.array(start, pa.int64()),
            "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()),
        })
        seen += len(rows)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    kept_bytes: int | None = None,
) -> DataFrame:
    """The pieces of every document with lengths and checksums; ``uid`` is unique.

    ``kept_bytes`` is what each worker holds of words it has met, see ``tokens``.
    """
    how = {"path": tokenizer_path, "end_id": end_id, "capacity": capacity}
    return as_text(docs, id_column, text_column).mapInArrow(
        partial(_cut_texts, kept_bytes=kept_bytes, **how), _PIECES
    )


def _pack_group(group: pa.Table, capacity: int) -> pa.Table:
    order = sorted(
        zip(group.column("uid").to_pylist(), group.column("length").to_pylist(), strict=True)
    )
    sizes = [n for _, n in order]
    places = best_fit(sizes, capacity)
    names: dict[int, int] = {}
    fill: dict[int, int] = {}
    for (uid, n), (bin_, _) in zip(order, places, strict=True):
        names.setdefault(bin_, uid)
        fill[bin_] = fill.get(bin_, 0) + n
    return pa.table({
        "uid": pa.array([uid for uid, _ in order], pa.int64()),
        "bin": pa.array([names[b] for b, _ in places], pa.int64()),
        "offset": pa.array([at for _, at in places], pa.int64()),
        "fill": pa.array([fill[b] for b, _ in places], pa.int64()),
    })


def _round(items: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    dealt = items.withColumn(
        "group", F.pmod(F.xxhash64("uid", F.lit(number)), F.lit(groups)).cast("int")
    )
    return dealt.groupBy("group").applyInArrow(
        lambda group: _pack_group(group, capacity), _PLACES
    )


def pack(
    pieces: DataFrame,
    capacity: int,
    work: str | None = None,
    group_items: int = 40_000,
    spare: int = 8,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``uid`` and ``length``.

    ``group_items`` bounds what one task packs; a bin with at most ``spare`` free
    places counts as full. The number of groups follows the number of items left.
    """
    spark = pieces.sparkSession
    work = workspace(spark, work)
    items = pieces.filter(F.col("length") < capacity).select("uid", "length")
    left = items.count()
    placed: DataFrame | None = None
    for number in range(_MAX_ROUNDS):
        groups = group_count(left, group_items)
        done = keep(_round(items, groups, number, capacity), work, f"round{number}")
        if placed is None:
            placed = done.select("uid", "bin", "offset")
        else:
            moved = done.select(
                F.col("uid").alias("bin"), F.col("bin").alias("into"), F.col("offset").alias("by")
            )
            placed = placed.join(moved, "bin", "left").select(
                "uid",
                F.coalesce("into", "bin").alias("bin"),
                (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset"),
            )
        open_bins = done.filter((F.col("uid") == F.col("bin")) & (F.col("fill") < capacity - spare))
        items = open_bins.select("uid", F.col("fill").alias("length"))
        before, left = left, items.count()
        # One group has met all items, or joining bins got stuck.
        if groups == 1 or left == 0 or (number and left > 0.99 * before):
            break
    return pieces.join(placed, "uid", "left").select(
        *[c for c in pieces.columns if c != "uid"],
        F.coalesce("bin", "uid").alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = 1024,
    work: str | None = None,
    kept_bytes: int | None = None,
    **how,
) -> DataFrame:
    """Cut and pack whole documents; see the module for the order of things."""
    work = workspace(docs.sparkSession, work)
    cut_up = token_pieces(docs, tokenizer_path, end_id, capacity, kept_bytes=kept_bytes)
    pieces = keep(cut_up, work, "pieces")
    return pack(pieces, capacity, work, **how)
