"""Operator 6: exact deduplication by an extendible-hash index on shared files.

Keys are SHA-256 values of normalised texts (each run of ASCII white space is one
space). The directory maps the leading bits of a key to a bucket, a folder of the
index. A bucket with too many entries or bytes is split by doubling the
directory there: its entries are dealt anew by more bits. A bucket that holds one
key cannot be split; its entries form a chain, read one at a time.

Each task first keeps one entry for the copies it has met itself, so a text that
fills a third of the table reaches its bucket once a task. An owner task reads
the buckets of its key range, chains entries with equal keys and compares their
bytes, so that two texts with one key stay apart. Then every row looks up its own
entry.

Defined cases: a null text is empty; of equal texts the smallest ``doc_id`` stays,
null ids last, and of rows with the same id one; texts of any length are compared whole; an
empty table gives no rows. Other columns of any name play no part, but for ``without_copies``,
which returns them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.frames import (
    as_text,
    digest,
    filesystem,
    keep,
    row_ids,
    rows_that_stay,
    slices,
    workspace,
)

_ROWS = "uid long, doc_id long, digest long, entry long, key binary, size long, text binary"
_OWNED = "entry long, class long, key binary"
#: Bytes of distinct texts that a task holds to find its own copies.
HELD_BYTES = 48 << 20
#: Bits of a key that the directory can use.
_KEY_BITS = 60
#: Buckets that a writing task and an owner take, as the number of tasks follows the buckets.
_TASK_BUCKETS, _OWNER_BUCKETS = 4, 8


def normalised(text: str = "text") -> Column:
    """``text`` with each run of ASCII white space as one space."""
    return F.regexp_replace(F.col(text), r"[\x20\x09-\x0D]+", " ")


def bucket_of(key: str, bits: int) -> Column:
    """The leading ``bits`` bits of a binary key as a number."""
    head = F.conv(F.substring(F.hex(key), 1, _KEY_BITS // 4), 16, 10).cast("long")
    return F.shiftright(head, _KEY_BITS - bits)


def _range_of(prefix: Column, bits: int, ranges: int) -> Column:
    """Which of ``ranges`` equal ranges of keys a prefix of ``bits`` bits lies in."""
    share = prefix.cast("double") / float(1 << bits)
    return F.least(F.floor(share * ranges), F.lit(ranges - 1)).cast("long")


def _local_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document; the first of a text in this task carries the text."""
    seen, held = 0, 0
    entries: dict[bytes, list[tuple[int, bytes]]] = {}
    for batch in slices(batches):
        uids = row_ids(seen, batch.num_rows)
        seen += batch.num_rows
        entry: list[int] = []
        numbers = uids.to_pylist()
        keys, texts = (batch.column(c).to_pylist() for c in ("key", "text"))
        for uid, key, text in zip(numbers, keys, texts, strict=True):
            known = next((e for e, t in entries.get(key, ()) if t == text), None)
            if known is None:
                if held > HELD_BYTES:
                    entries.clear()
                    held = 0
                entries.setdefault(key, []).append((uid, text))
                held += len(text) + 200
            entry.append(uid if known is None else known)
        first = [a == b for a, b in zip(entry, numbers, strict=True)]

        def of_first(values: list[bytes], first: list[bool] = first) -> pa.Array:
            kept = [x if f else None for x, f in zip(values, first, strict=True)]
            return pa.array(kept, pa.binary())

        yield pa.record_batch({
            "uid": uids,
            "doc_id": batch.column("doc_id"),
            "digest": batch.column("digest"),
            "entry": pa.array(entry, pa.int64()),
            "key": of_first(keys),
            "size": pa.array([len(x) for x in texts], pa.int64()),
            "text": of_first(texts),
        })


class Index:
    """The directory: a folder of entries for the keys that share leading bits.

    Its leaves are a table of (bits, prefix, bytes), a row for thousands of documents. Tasks and
    owners each take a range of keys: keys are digests, so equal ranges hold about as much, and
    the number of ranges follows the number of buckets. Rows without a key lie beside the
    buckets of the first depth.
    """

    def __init__(self, work: str, rows: int, bytes_: int):
        self.work, self.rows, self.bytes = work, rows, bytes_
        self.depths: list[DataFrame] = []
        self.widest = 1

    def folder(self, bits: int) -> str:
        return f"{self.work}/index/depth={bits}"

    def add(self, rows: DataFrame, bits: int) -> DataFrame:
        """Write ``rows`` into buckets of ``bits`` bits, split those that overflow.

        Returns what was written, as a frame.
        """
        spark = rows.sparkSession
        self.widest = max(self.widest, 1 << bits)
        tasks = max(spark.sparkContext.defaultParallelism, (1 << bits) // _TASK_BUCKETS)
        bucket = F.coalesce(bucket_of("key", bits), F.lit(-1))
        # Rows without a key are spread by their number.
        task = F.when(bucket < 0, F.pmod(F.xxhash64("uid"), F.lit(tasks))).otherwise(
            _range_of(bucket, bits, tasks)
        )
        (
            rows.withColumn("bucket", bucket)
            .repartitionById(tasks, task.cast("int"))
            .write.option("compression", "zstd")
            .partitionBy("bucket")
            .parquet(self.folder(bits))
        )
        written = spark.read.schema(f"{_ROWS}, bucket long").parquet(self.folder(bits))
        full = F.col("many") & ((F.col("n") > self.rows) | (F.col("size") > self.bytes))
        found = keep(
            written.filter("bucket >= 0")
            .groupBy("bucket")
            .agg(
                F.count("*").alias("n"),
                F.sum("size").alias("size"),
                (F.min("key") != F.max("key")).alias("many"),
            )
            .withColumn("full", full & F.lit(bits < _KEY_BITS)),
            self.work,
            "depth",
        )
        self.depths.append(
            found.filter("NOT full").select(
                F.lit(bits).alias("bits"), F.col("bucket").alias("prefix"), "size"
            )
        )
        split = found.filter("full").select("bucket")
        if not split.isEmpty():
            self.add(written.join(split, "bucket", "left_semi").select(*rows.columns), bits + 1)
        return written

    @property
    def leaves(self) -> DataFrame:
        """``bits, prefix, size`` of every bucket that was not split."""
        return reduce(DataFrame.union, self.depths)

    def owners(self, spark: SparkSession) -> DataFrame:
        """``owner, paths``: the buckets that each owner task reads, a range of keys each."""
        n = max(2 * spark.sparkContext.defaultParallelism, self.widest // _OWNER_BUCKETS)
        path = F.concat(
            F.lit(f"{self.work}/index/depth="), "bits", F.lit("/bucket="), F.col("prefix")
        )
        start = F.expr(f"shiftleft(prefix, {_KEY_BITS} - bits)")
        owner = _range_of(start, _KEY_BITS, n).alias("owner")
        return (
            self.leaves.select(owner, path.alias("path"))
            .groupBy("owner")
            .agg(F.collect_list("path").alias("paths"))
            .repartitionById(n, F.col("owner").cast("int"))
        )


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the entries of each bucket; memory: the distinct texts of one bucket."""
    for batch in batches:
        for path in [p for paths in batch.column("paths").to_pylist() for p in paths]:
            fs, name = filesystem(path)
            # Under each key the first entry and the text of each class.
            chains: dict[bytes, list[tuple[int, bytes]]] = {}
            for rows in ds.dataset(name, filesystem=fs, format="parquet").to_batches(
                columns=["uid", "key", "text"], batch_size=512, batch_readahead=1
            ):
                keys = rows.column("key").to_pylist()
                classes = []
                columns = (rows.column(c).to_pylist() for c in ("uid", "text"))
                for key, uid, text in zip(keys, *columns, strict=True):
                    chain = chains.setdefault(key, [])
                    own = next((first for first, known in chain if known == text), None)
                    if own is None:
                        chain.append((uid, text))
                        own = uid
                    classes.append(own)
                yield pa.record_batch({
                    "entry": rows.column("uid"),
                    "class": pa.array(classes, pa.int64()),
                    "key": rows.column("key"),
                })


def exact_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    work: str | None = None,
    bucket_rows: int = 8192,
    bucket_bytes: int = 64 << 20,
) -> DataFrame:
    """``uid, doc_id, digest, keep_id, group_size, kept, text_sha256`` for each row.

    ``bucket_rows`` and ``bucket_bytes`` are the capacity of a bucket.
    """
    spark = docs.sparkSession
    work = workspace(spark, work)
    rows = (
        as_text(docs, id_column, text_column)
        .select("doc_id", digest().alias("digest"), normalised().alias("text"))
        .select(
            "doc_id",
            "digest",
            F.unhex(F.sha2("text", 256)).alias("key"),
            F.encode("text", "UTF-8").alias("text"),
        )
        .mapInArrow(_local_entries, _ROWS)
    )
    index = Index(work, bucket_rows, bucket_bytes)
    bits = max(1, math.ceil(math.log2(max(2, docs.count() / (bucket_rows / 4)))))
    members = index.add(rows, bits).select("uid", "doc_id", "digest", "entry")
    owned = keep(index.owners(spark).select("paths").mapInArrow(_own, _OWNED), work, "owned")
    # Sums go from copies to entries and from entries to classes, so that a
    # frequent text is never one key with all its rows.
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")
    entries = (
        members.groupBy("entry")
        .agg(F.min(row).alias("first"), F.count("*").alias("n"))
        .join(owned, "entry")
    )
    classes = entries.groupBy("class").agg(
        F.min("first").alias("first"), F.sum("n").alias("group_size")
    )
    results = owned.join(classes, "class").select("entry", "key", "first", "group_size")
    return members.join(results, "entry").select(
        "uid",
        "doc_id",
        "digest",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("uid") == F.col("first.uid")).alias("kept"),
        F.lower(F.hex("key")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, work: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each text."""
    work = workspace(docs.sparkSession, work)
    return rows_that_stay(docs, exact_copies(docs, work=work), work)
