"""Helpers that the operators share: tables, scratch space, row ids, files."""

from __future__ import annotations

import ctypes
import posixpath
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.scratch import scratch_dir

T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _ship(application: str) -> str:
    package = Path(__file__).resolve().parent.parent
    path = f"{tempfile.mkdtemp(prefix='tripmill-')}/tripmill.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    return path


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session; they may not have it installed."""
    spark.sparkContext.addPyFile(_ship(spark.sparkContext.applicationId))


def keep(df: DataFrame, work: str, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared folder ``work`` and read it back.

    Cuts the lineage: what follows survives the loss of any executor, and row ids
    given out while writing stay the same however often the table is read.
    """
    path = f"{work}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def workspace(spark: SparkSession, work: str | None) -> str:
    """``work``, or a new folder below the one that ``spark.checkpoint.dir`` names."""
    return work.rstrip("/") if work else scratch_dir(spark)


def row_ids(start: int, n: int) -> pa.Array:
    """Ids that no other task gives out: the task's number, then a counter."""
    context = TaskContext.get()
    base = ((context.partitionId() if context else 0) << 36) + start
    return pa.array(range(base, base + n), pa.int64())


#: What this worker process keeps, for one operator at a time.
_KEPT: dict = {}


def give_back() -> None:
    """Return freed memory to the machine, which the allocators would hold for later."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept_for(owner: Hashable, make: Callable[[], T]) -> T:
    """A cache or model that a worker keeps between the tasks of one operator.

    Workers outlive their tasks, so what another operator has left goes first.
    """
    if owner not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[owner] = make()
    return _KEPT[owner]


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = 512, keeps: bool = False
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` a few at a time, for work on Python objects of them.

    Unless the operator ``keeps`` something, what others have left in this worker goes.
    """
    if not keeps:
        _KEPT.clear()
    give_back()
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """The strings of an Arrow column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def group_count(rows: int, per_group: int) -> int:
    return max(1, -(-rows // per_group))


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path inside it."""
    return pafs.FileSystem.from_uri(path)


@contextmanager
def replacing(path: str) -> Iterator[pa.NativeFile]:
    """Write a file under a name of this attempt's own and rename it in the end.

    A task that is tried again, or runs twice at a time, leaves one whole file.
    """
    fs, name = filesystem(path)
    fs.create_dir(posixpath.dirname(name), recursive=True)
    own = f"{name}.{uuid.uuid4().hex}.tmp"
    try:
        with fs.open_output_stream(own) as out:
            yield out
        fs.move(own, name)
    except BaseException:
        if fs.get_file_info(own).type == pafs.FileType.File:
            fs.delete_file(own)
        raise


def as_text(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) of a table with any other columns."""
    return df.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )


def digest(text: str = "text") -> Column:
    """A short digest of a text, which tells rows with one id apart."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


#: Rows of 16 bytes that a decision on documents sends to all tasks at most.
SENT_ROWS = 1_000_000


def rows_that_stay(docs: DataFrame, decisions: DataFrame, work: str) -> DataFrame:
    """The rows of ``docs``, all columns, that ``decisions`` keep.

    ``decisions`` has ``doc_id``, ``digest`` and ``kept`` for every row of ``docs``,
    which has ``doc_id`` and ``text``. Where rows agree in id and text and
    one of them stays, one does.
    """
    marks = decisions.groupBy("doc_id", "digest").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n")
    )
    marks = keep(marks.filter("NOT kept OR n > 1"), work, "marks")
    names = {"doc_id": "_id_of_mark", "digest": "_digest_of_mark"}
    sides = []
    for wanted in ("NOT kept", "kept"):
        side = marks.filter(wanted).select(*[F.col(a).alias(b) for a, b in names.items()])
        n = side.count()
        sides.append((F.broadcast(side) if n <= SENT_ROWS else side, n))
    (gone, n_gone), (doubled, n_doubled) = sides
    own = F.col("doc_id").cast("long").eqNullSafe(F.col("_id_of_mark")) & (
        digest() == F.col("_digest_of_mark")
    )
    left = docs.join(gone, own, "left_anti") if n_gone else docs
    if n_doubled:
        columns = left.columns
        one = left.join(doubled, own, "left_semi").withColumn("_digest_of_row", digest())
        one = one.dropDuplicates(["doc_id", "_digest_of_row"]).select(*[F.col(f"`{c}`") for c in columns])
        left = left.join(doubled, own, "left_anti").union(one)
    return left
