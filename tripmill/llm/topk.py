"""Operator 2: exact top-k by inner product, a block at a time.

Vectors are turned into integers and laid out in blocks, ranges of rows in an order
that keeps similar vectors together. A block has a forward index, its vectors, and
for each term (dimension) its greatest and least value. The sum over a query's
terms of the greatest product bounds every score in the block.

1. Bounds of all blocks for each query come from the summaries alone; each query
   is scored through the blocks with the highest bounds, which gives a score that
   its k-th best reaches at least.
2. Blocks whose bound falls below that for all queries of a group are dropped.
   What is left is scored, the highest bound first, until the next bound is below
   the k-th best score so far. A bound equal to it is still scored, for the ties.

Queries and blocks meet in groups of bounded size, dealt by pairs of query group and
block group. Query groups are salted, so that a block which all queries want is
scored in many tasks.

Defined cases: vectors that are null, or hold a null or a component that is not finite,
and rows without an id take no part; shorter vectors count as filled up with zeros;
rows with one id are apart, each is a candidate for the other; fewer than k
candidates give fewer rows; a score beyond 64 bits raises an error; an empty table gives no
rows. Other columns of any name play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.frames import group_count, keep, row_ids, workspace

BLOCK_ROWS, QUERY_GROUP, BLOCK_GROUP, SUMMARY_GROUP = 256, 256, 32, 2048
#: Blocks that the first step scores for each query; pivots that order the vectors.
SEEDS, PIVOTS = 3, 64
#: Below this sum of products doubles are exact.
_EXACT = 1 << 53

_BLOCKS = "block long, uids binary, ids binary, terms binary, most binary, least binary"
_FOUND = "query_uid long, query_id long, vec_id long, uid long, score long"


def quantised(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``vec_id, vector``: floor(scale * x) of each component of the sound vectors."""
    vector = F.col(f"`{vector_column}`")
    sound = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return rows.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale))).alias(
            "vector"
        ),
    ).filter("vec_id IS NOT NULL AND vector IS NOT NULL")


@dataclass(frozen=True)
class Shape:
    """Terms of a vector; whether doubles add up scores exactly."""

    terms: int
    exact: bool

    def matrix(self, vectors: list[list[int]]) -> np.ndarray:
        out = np.zeros((len(vectors), self.terms), np.int64)
        for i, vector in enumerate(vectors):
            out[i, : len(vector)] = vector
        return out

    def load(self, packed: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(packed), "<i8").reshape(-1, self.terms)

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner products of the rows, as exact integers."""
        if self.exact:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        whole = a.astype(object) @ b.astype(object).T
        if whole.size and max(abs(int(whole.max())), abs(int(whole.min()))) >= 1 << 63:
            raise OverflowError("a score does not fit into 64 bits")
        return whole.astype(np.int64)

    def bounds(self, queries: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
        """For each query and block the sum of the greatest product of each term."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        if self.exact:
            return self.products(up, most) + self.products(down, least)
        up, down = up.astype(object), down.astype(object)
        return up @ most.astype(object).T + down @ least.astype(object).T


# Blocks


def _chained(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest one left.

    Vectors and queries are dealt by the number of their pivot, so neighbours stay together.
    """
    left, order = list(range(len(pivots))), []
    at = 0
    while left:
        order.append(left.pop(at))
        if left:
            at = int(((pivots[left] - pivots[order[-1]]) ** 2).sum(axis=1).argmin())
    return pivots[order]


def _nearest(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, shape: Shape):
    """Number the rows and find the nearest pivot of each."""
    seen = 0
    for batch in batches:
        vectors = shape.matrix(batch.column("vector").to_pylist())
        flat = vectors.astype(np.float64)
        far = (pivots**2).sum(axis=1) - 2 * flat @ pivots.T
        yield pa.record_batch({
            "uid": row_ids(seen, batch.num_rows),
            "vec_id": batch.column("vec_id"),
            "pivot": pa.array(far.argmin(axis=1) if len(pivots) else [0] * len(flat), pa.int32()),
            "terms": pa.array([v.astype("<i8").tobytes() for v in vectors], pa.binary()),
        })
        seen += batch.num_rows


def _blocks(batches: Iterator[pa.RecordBatch], shape: Shape) -> Iterator[pa.RecordBatch]:
    """Consecutive rows as blocks; memory: one block."""
    number = 0
    held: list[tuple[int, int, bytes]] = []

    def flush() -> pa.RecordBatch:
        nonlocal number
        uids, ids, terms = zip(*held, strict=True)
        vectors = shape.load(list(terms))
        row = pa.record_batch({
            "block": row_ids(number, 1),
            "uids": pa.array([np.array(uids, "<i8").tobytes()], pa.binary()),
            "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
            "terms": pa.array([b"".join(terms)], pa.binary()),
            "most": pa.array([vectors.max(axis=0).tobytes()], pa.binary()),
            "least": pa.array([vectors.min(axis=0).tobytes()], pa.binary()),
        })
        number += 1
        held.clear()
        return row

    before = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("uid", "vec_id", "pivot", "terms"))
        for uid, vec_id, pivot, terms in zip(*columns, strict=True):
            # A new range begins where a block is full, or half full at a new pivot.
            if len(held) == BLOCK_ROWS or pivot != before and 2 * len(held) >= BLOCK_ROWS:
                yield flush()
            before = pivot
            held.append((uid, vec_id, terms))
    if held:
        yield flush()


# Searching


def _best_blocks(queries: pa.Table, summaries: pa.Table, shape: Shape) -> pa.Table:
    """The blocks with the highest bounds for each query."""
    own = shape.load(queries.column("terms").to_pylist())
    most, least = (shape.load(summaries.column(c).to_pylist()) for c in ("most", "least"))
    bounds = shape.bounds(own, most, least)
    best = np.argsort(-bounds, axis=1, kind="stable")[:, :SEEDS]
    rows = np.repeat(np.arange(len(own)), best.shape[1])
    columns = best.reshape(-1)
    return pa.table({
        "query_uid": queries.column("query_uid").take(pa.array(rows)),
        "block": summaries.column("block").take(pa.array(columns)),
        "bound": pa.array([int(b) for b in bounds[rows, columns]], pa.int64()),
    })


def _wanted(queries: pa.Table, summaries: pa.Table, shape: Shape) -> pa.Table:
    """The blocks in which some query of the group may still find something."""
    own = shape.load(queries.column("terms").to_pylist())
    most, least = (shape.load(summaries.column(c).to_pylist()) for c in ("most", "least"))
    floor = np.array(queries.column("floor").to_pylist())
    open_ = (shape.bounds(own, most, least) >= floor[:, None]).any(axis=0)
    blocks = summaries.column("block").filter(pa.array(open_.astype(bool)))
    group = queries.column("query_group")[0].as_py()
    return pa.table({
        "query_group": pa.array([group] * len(blocks), pa.int32()),
        "block": blocks,
    })


def _score(queries: pa.Table, blocks: pa.Table, shape: Shape, k: int) -> pa.Table:
    """Score blocks in the order of their bounds until they fall below the k-th score."""
    own = shape.load(queries.column("terms").to_pylist())
    query_uids = queries.column("query_uid").to_pylist()
    floors = queries.column("floor").to_pylist()
    most, least = (shape.load(blocks.column(c).to_pylist()) for c in ("most", "least"))
    bounds = shape.bounds(own, most, least)
    index = [
        (shape.load([t]), np.frombuffer(i, "<i8"), np.frombuffer(u, "<i8"))
        for t, i, u in zip(
            *(blocks.column(c).to_pylist() for c in ("terms", "ids", "uids")), strict=True
        )
    ]
    # (-score, vec_id, uid) of the best so far of each query.
    best: list[list[tuple[int, int, int]]] = [[] for _ in query_uids]
    kth = list(floors)
    order = np.argsort(-bounds, axis=1, kind="stable")
    going = list(range(len(own)))
    for step in range(len(index)):
        going = [q for q in going if bounds[q, order[q, step]] >= kth[q]]
        if not going:
            break
        by_block: dict[int, list[int]] = {}
        for q in going:
            by_block.setdefault(int(order[q, step]), []).append(q)
        for b, asking in by_block.items():
            vectors, ids, uids = index[b]
            for q, scores in zip(asking, shape.products(own[asking], vectors), strict=True):
                rows = np.flatnonzero((scores >= kth[q]) & (uids != query_uids[q]))
                found = [(-int(scores[r]), int(ids[r]), int(uids[r])) for r in rows]
                best[q] = sorted(best[q] + found)[:k]
                if len(best[q]) == k:
                    kth[q] = max(kth[q], -best[q][-1][0])
    rows = [
        (query_uids[q], query_id, vec_id, uid, -minus)
        for q, query_id in enumerate(queries.column("query_id").to_pylist())
        for minus, vec_id, uid in best[q]
    ]
    names = ("query_uid", "query_id", "vec_id", "uid", "score")
    return pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


def _copies(df: DataFrame, column: str, n: int) -> DataFrame:
    """Each row once for each of ``n`` groups of the other side."""
    return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def _grouped(queries: DataFrame) -> tuple[DataFrame, int]:
    """Add ``query_group``, about ``QUERY_GROUP`` queries each, and say how many groups there are.

    Queries near one pivot share a group as far as they fill it, so a group's queries
    want the same blocks. There is a row for each pivot, of which there are ``PIVOTS`` at most.
    """
    spark, places, total = queries.sparkSession, [], 0
    for row in queries.groupBy("pivot").count().orderBy("pivot").collect():
        places.append((row["pivot"], total, row["count"]))
        total += row["count"]
    near = spark.createDataFrame(places, "pivot int, earlier long, near long")
    place = F.col("earlier") + F.pmod(F.xxhash64("query_uid"), F.col("near"))
    group = F.floor(place / QUERY_GROUP).cast("int").alias("query_group")
    dealt = queries.join(F.broadcast(near), "pivot").select(
        "query_uid", "query_id", "terms", group
    )
    return dealt, group_count(total, QUERY_GROUP)


def top_k(
    rows: DataFrame,
    is_query,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    work: str | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows for each query row.

    ``is_query`` is an expression over ``vec_id``. Ties go to the smaller ``vec_id``.
    """
    spark = rows.sparkSession
    work = workspace(spark, work)
    vectors = keep(quantised(rows, id_column, vector_column, scale), work, "vectors")
    size = vectors.agg(
        F.max(F.size("vector")).alias("terms"),
        F.max(F.array_max(F.transform("vector", F.abs))).alias("greatest"),
    ).first()
    terms = max(1, size["terms"] or 0)
    shape = Shape(terms, terms * (size["greatest"] or 0) ** 2 < _EXACT)
    pivots = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    pivots = _chained(shape.matrix([r["vector"] for r in pivots]).astype(np.float64))
    numbered = keep(
        vectors.mapInArrow(
            partial(_nearest, pivots=pivots, shape=shape),
            "uid long, vec_id long, pivot int, terms binary",
        ),
        work,
        "numbered",
    )
    n = numbered.count()
    tasks = max(spark.sparkContext.defaultParallelism, group_count(n, 64 * BLOCK_ROWS))
    blocks = keep(
        numbered.repartitionByRange(tasks, "pivot", "vec_id", "uid")
        .sortWithinPartitions("pivot", "vec_id", "uid")
        .mapInArrow(partial(_blocks, shape=shape), _BLOCKS),
        work,
        "blocks",
    )
    queries = numbered.filter(is_query).select(
        F.col("uid").alias("query_uid"), F.col("vec_id").alias("query_id"), "terms", "pivot"
    )
    queries, query_groups = _grouped(queries)
    queries = keep(queries, work, "queries")
    n_blocks = blocks.count()
    parts = group_count(n_blocks, SUMMARY_GROUP)
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")
    summaries = _copies(
        blocks.select("block", "most", "least").withColumn("part", part), "query_group", query_groups
    )

    def meet(asking: DataFrame, task, schema: str) -> DataFrame:
        return (
            _copies(asking, "part", parts)
            .groupBy("query_group", "part")
            .cogroup(summaries.groupBy("query_group", "part"))
            .applyInArrow(lambda a, b: task(a, b, shape) if len(a) and len(b) else _empty(schema), schema)
        )

    def scored(asking: DataFrame, pairs: DataFrame, keys: list[str]) -> DataFrame:
        """``pairs`` of ``block`` and the columns ``keys`` that queries have too."""
        content = pairs.join(blocks, "block")
        return (
            asking.groupBy(*keys)
            .cogroup(content.groupBy(*keys))
            .applyInArrow(
                lambda a, b: _score(a, b, shape, k) if len(a) and len(b) else _empty(_FOUND), _FOUND
            )
        )

    # 1. A score that the k-th best reaches, from the most promising blocks.
    lowest = -(1 << 62)
    order = Window.partitionBy("query_uid").orderBy(F.desc("bound"), "block")
    seeds = keep(
        meet(queries, _best_blocks, "query_uid long, block long, bound long")
        .withColumn("at", F.row_number().over(order))
        .filter(F.col("at") <= SEEDS)
        .join(queries, "query_uid")
        .select("query_uid", "query_id", "terms", "query_group", "block")
        .withColumn("floor", F.lit(lowest))
        .withColumn("seed", F.col("block")),
        work,
        "seeds",
    )
    pairs = keep(seeds.select("query_group", "block", "seed").distinct(), work, "pairs")
    first = keep(scored(seeds, pairs, ["query_group", "seed"]), work, "first")
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    floors = (
        first.withColumn("at", F.row_number().over(best))
        .filter(F.col("at") == k)
        .select("query_uid", F.col("score").alias("floor"))
    )
    asking = keep(
        queries.join(floors, "query_uid", "left").fillna({"floor": lowest}), work, "asking"
    )
    # 2. Every block that can still hold one of the k best.
    wanted = keep(meet(asking, _wanted, "query_group int, block long"), work, "wanted")
    block_groups = group_count(n_blocks, BLOCK_GROUP)
    dealt = wanted.withColumn(
        "block_group", F.pmod(F.xxhash64("block"), F.lit(block_groups)).cast("int")
    )
    # Queries go to the groups of blocks that their group wants something of, and to no other.
    visits = keep(dealt.select("query_group", "block_group").distinct(), work, "visits")
    found = scored(asking.join(visits, "query_group"), dealt, ["query_group", "block_group"])
    return (
        found.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in fields})
