"""Operator 11: mix sources to target weights, in blocks that are drawn by index.

The words of each source, in the order of its documents, are packed into blocks of fixed
length; only a source's last block is shorter. Each shard of the mix draws how
many of its slots go to each source from a multinomial distribution over the targets. The
slots of a source are numbered through all shards, and a pseudorandom permutation of
the source's block numbers says which block a slot takes: a new permutation for each
time the source is gone through, so no block is taken a second time before all were
taken once. Slots and blocks then meet in an equi-join on source and block number.

Independent draws miss the targets by chance. So the slots that a source has drawn
beyond its own number (chosen by a further permutation) are handed to the sources that
have drawn too few, and the last slot of a source takes only the words that are left to
take: a mix has exactly ``round(target)`` words of each source, whatever the block length.

All numbers come from the seed, shard numbers and sizes; reruns and retried tasks agree.
The driver holds the table of sources (one row each, as the weights do) and no more.

Defined cases: null and empty texts have size 0 and are never taken; a null source is a
source, the last one; rows with the same id are documents of their own (equal ones may
be taken a different number of times); ids may be null and come first; an empty table, or
one without words, gives an empty mix; texts of any length are cut into blocks; other columns
of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.frames import digest, group_count, keep, workspace

#: Words of a block, slots of a shard, and shards that a task draws one after another.
BLOCK, SHARD, GROUP = 64, 4096, 16

_SLOTS = "shard long, slot int, source_no int, epoch int, block long, words int"


def targets(sizes: list[int], weights: list[int], most: int = 3) -> list[float]:
    """How many words to take of each source: all words shared by weight, none above
    ``most`` times its size, and what is cut off shared again by weight."""
    total, held = sum(sizes), {}
    while True:
        left = total - sum(held.values())
        parts = sum(w for i, w in enumerate(weights) if i not in held)
        shares = {
            i: Fraction(left * w, parts) for i, w in enumerate(weights) if i not in held and parts
        }
        above = {i: Fraction(most * sizes[i]) for i, x in shares.items() if x > most * sizes[i]}
        if not above:
            return [float(held.get(i, shares.get(i, 0))) for i in range(len(sizes))]
        held |= above


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """Well-mixed bits of each number, different for each key (splitmix64's steps)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(key & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Permutation:
    """A pseudorandom permutation of 0 to n - 1 that needs no table.

    Four Feistel rounds permute the next power of four; a number that lands beyond n is
    sent on until it lands within.
    """

    n: int
    key: tuple[int, ...]

    def _keys(self) -> list[int]:
        state = np.random.SeedSequence(self.key).generate_state(4, np.uint64)
        return [int(k) for k in state]

    @property
    def _half(self) -> int:
        return max(1, -(-(self.n - 1).bit_length() // 2))

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self._half)
        mask = np.uint64((1 << self._half) - 1)
        left, right = x >> half, x & mask
        for key in reversed(self._keys()) if back else self._keys():
            if back:
                left, right = right ^ (_mixed(left, key) & mask), left
            else:
                left, right = right, left ^ (_mixed(right, key) & mask)
        return (left << half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), back)
        outside = np.flatnonzero(x >= self.n)
        while len(outside):
            x[outside] = self._once(x[outside], back)
            outside = outside[x[outside] >= self.n]
        return x.astype(np.int64)

    def at(self, places: np.ndarray) -> np.ndarray:
        """The number at each place."""
        return self._walk(places, back=False)

    def place(self, number: int) -> int:
        """The place of a number."""
        return int(self._walk(np.array([number]), back=True)[0])


@dataclass(frozen=True)
class Share:
    """What the mix takes of one source."""

    no: int
    size: int
    blocks: int
    slots: int
    #: Words that the last slot takes of its block at most.
    last: int


def share(no: int, size: int, taken: int, block: int, seed: int) -> Share:
    """Slots that take exactly ``taken`` of ``size`` words."""
    if not size or not taken:
        return Share(no, size, group_count(size, block) if size else 0, 0, block)
    blocks = group_count(size, block)
    epochs, rest = divmod(taken, size)
    if not rest:
        return Share(no, size, blocks, epochs * blocks, block)
    short = size - (blocks - 1) * block
    # Slots of the last, partial round up to the short block, which it may hold.
    at = Permutation(blocks, (seed, no, epochs)).place(blocks - 1)
    if rest <= at * block:
        slots = group_count(rest, block)
        last = rest - (slots - 1) * block
    else:
        beyond = rest - at * block - short
        more = -(-beyond // block) if beyond > 0 else 0
        slots = at + 1 + more
        last = beyond - (more - 1) * block if more else rest - at * block
    return Share(no, size, blocks, epochs * blocks + slots, last)


@dataclass(frozen=True)
class Plan:
    """All shares of a mix, and how shards draw from them."""

    shares: tuple[Share, ...]
    shard: int
    seed: int

    @property
    def slots(self) -> int:
        return sum(s.slots for s in self.shares)

    @property
    def shards(self) -> int:
        return -(-self.slots // self.shard)

    def drawn(self, shard: int) -> np.ndarray:
        """How many slots of a shard go to each source, before any are handed on."""
        n = min(self.shard, self.slots - shard * self.shard)
        odds = np.array([s.slots for s in self.shares], float)
        draw = np.random.default_rng((self.seed, 1, shard))
        return draw.multinomial(n, odds / odds.sum())


def _draw(
    batches: Iterator[pa.RecordBatch], plan: Plan, group: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number in batch.column("id").to_pylist():
            shards = range(number * group, min((number + 1) * group, plan.shards))
            n = sum((plan.drawn(s) for s in shards), np.zeros(len(plan.shares), np.int64))
            nos = np.flatnonzero(n)
            yield pa.record_batch({
                "group": pa.array(np.full(len(nos), number), pa.int64()),
                "source_no": pa.array(nos, pa.int32()),
                "n": pa.array(n[nos], pa.int64()),
            })


class _Handing:
    """Which slots each source keeps of those it has drawn, and who gets the others."""

    def __init__(self, plan: Plan, drawn: list[int]):
        own = [s.slots for s in plan.shares]
        over = [max(0, d - n) for d, n in zip(drawn, own, strict=True)]
        under = [max(0, n - d) for d, n in zip(drawn, own, strict=True)]
        self.plan, self.drawn, self.own = plan, drawn, own
        self.over_at = np.concatenate([[0], np.cumsum(over)])
        self.under_at = np.concatenate([[0], np.cumsum(under)])
        self.over = over

    def slots(self, no: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source and number within it of the ``numbers``-th slots that ``no`` has drawn."""
        nos = np.full(len(numbers), no)
        if not self.over[no]:
            return nos, numbers
        seed = self.plan.seed
        image = Permutation(self.drawn[no], (seed, 2, no)).at(numbers)
        handed = np.flatnonzero(image >= self.own[no])
        if len(handed):
            all_handed = Permutation(int(self.over_at[-1]), (seed, 3))
            at = all_handed.at(self.over_at[no] + image[handed] - self.own[no])
            to = np.searchsorted(self.under_at, at, side="right") - 1
            nos[handed] = to
            image[handed] = np.array(self.drawn)[to] + at - self.under_at[to]
        return nos, image


def _fill(
    batches: Iterator[pa.RecordBatch], plan: Plan, group: int, block: int, drawn: list[int]
) -> Iterator[pa.RecordBatch]:
    """The slots of groups of shards; each row has what the groups before it have drawn."""
    handing = _Handing(plan, drawn)
    for batch in batches:
        for row in batch.to_pylist():
            before = np.zeros(len(plan.shares), np.int64)
            before[row["nos"]] = row["before"]
            for shard in range(row["group"] * group, min((row["group"] + 1) * group, plan.shards)):
                n = plan.drawn(shard)
                parts = []
                for no in np.flatnonzero(n).tolist():
                    parts.append(handing.slots(no, before[no] + np.arange(n[no])))
                before += n
                nos, numbers = (np.concatenate(x) for x in zip(*parts, strict=True))
                epochs = np.zeros(len(nos), np.int64)
                blocks = np.zeros(len(nos), np.int64)
                words = np.full(len(nos), block)
                for no in np.unique(nos).tolist():
                    own, mine = np.flatnonzero(nos == no), plan.shares[no]
                    epochs[own], places = np.divmod(numbers[own], mine.blocks)
                    for epoch in np.unique(epochs[own]).tolist():
                        at = epochs[own] == epoch
                        order = Permutation(mine.blocks, (plan.seed, no, epoch))
                        blocks[own[at]] = order.at(places[at])
                    words[own[numbers[own] == mine.slots - 1]] = mine.last
                # Sources are mixed within the shard.
                order = np.random.default_rng((plan.seed, 4, shard)).permutation(len(nos))
                yield pa.record_batch({
                    "shard": pa.array(np.full(len(nos), shard), pa.int64()),
                    "slot": pa.array(np.arange(len(nos)), pa.int32()),
                    "source_no": pa.array(nos[order], pa.int32()),
                    "epoch": pa.array(epochs[order], pa.int32()),
                    "block": pa.array(blocks[order], pa.int64()),
                    "words": pa.array(words[order], pa.int32()),
                })


def slots(spark: SparkSession, plan: Plan, block: int, work: str, group: int = GROUP) -> DataFrame:
    """Every slot of the mix with its source, block and the words it takes at most."""
    if not plan.slots:
        return spark.createDataFrame([], _SLOTS)
    groups = group_count(plan.shards, group)
    tasks = min(groups, 64 * spark.sparkContext.defaultParallelism)
    draws = keep(
        spark.range(0, groups, 1, tasks).mapInArrow(
            partial(_draw, plan=plan, group=group), "group long, source_no int, n long"
        ),
        work,
        "draws",
    )
    drawn = [0] * len(plan.shares)
    for row in draws.groupBy("source_no").agg(F.sum("n").alias("n")).collect():
        drawn[row["source_no"]] = row["n"]
    earlier = Window.partitionBy("source_no").orderBy("group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begun = draws.select(
        "group", "source_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    pairs = F.sort_array(F.collect_list(F.struct("source_no", "before")))
    lists = begun.groupBy("group").agg(pairs.alias("x"))
    # A few rows of a group stand for all its slots: keep every group's task its own.
    return lists.select(
        "group", F.col("x.source_no").alias("nos"), F.col("x.before").alias("before")
    ).repartition(tasks, "group").mapInArrow(
        partial(_fill, plan=plan, group=group, block=block, drawn=drawn), _SLOTS
    )


def _sizes(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            # Bytes are split at ASCII white space only.
            words = [x.split() for x in part.column("text").cast(pa.binary()).to_pylist()]
            out = {c: part.column(c) for c in ("doc_id", "source", "digest")}
            out["size"] = pa.array([len(x) for x in words], pa.int64())
            if texts:
                joined = pa.array([b" ".join(x) for x in words], pa.binary())
                out["text"] = joined.cast(pa.string())
            yield pa.record_batch(out)


def _run_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``within``: the words of the source's earlier rows in this sorted partition."""
    source, begun = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        nos = batch.column("source_no").to_numpy()
        sizes = batch.column("size").to_numpy()
        within = np.cumsum(sizes) - sizes
        first = np.flatnonzero(np.append(True, nos[1:] != nos[:-1]))
        base = np.repeat(within[first], np.diff(np.append(first, len(nos))))
        within = within - base
        if nos[0] == source:
            within[: first[1] if len(first) > 1 else len(nos)] += begun
        source, begun = nos[-1], int(within[-1] + sizes[-1])
        yield batch.append_column("within", pa.array(within, pa.int64()))


@dataclass(frozen=True)
class Mixture:
    """``sources`` (source_no, source, source_size, target), ``documents`` (doc_id, source_no,
    size, start), ``blocks`` and ``slots`` of a mix."""

    sources: DataFrame
    documents: DataFrame
    blocks: DataFrame
    slots: DataFrame

    def mixed(self) -> DataFrame:
        """Slots with the segments of their blocks: the mix itself."""
        # Slots grow with the input, and Spark cannot tell how many a row of a group makes.
        return self.slots.hint("merge").join(self.blocks, ["source_no", "block"])

    def taken(self) -> DataFrame:
        """Every document with the words that the mix takes of it, repeats counted."""
        # Of a slot that takes only the first words, later segments give less.
        used = F.greatest(F.lit(0), F.least("s.words", F.col("words") - F.col("s.at")))
        by_document = (
            self.mixed()
            .select("source_no", "words", F.explode("segments").alias("s"))
            .groupBy("source_no", F.col("s.start").alias("start"))
            .agg(F.sum(used).alias("taken"))
        )
        # A document without words starts where the next one does.
        with_words = self.documents.withColumn(
            "place", F.when(F.col("size") > 0, F.col("start"))
        )
        on = (with_words["source_no"] == by_document["source_no"]) & (
            with_words["place"] == by_document["start"]
        )
        return (
            with_words.join(by_document, on, "left")
            .select(
                "doc_id",
                with_words["source_no"],
                "size",
                F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            )
            .join(F.broadcast(self.sources), "source_no")
            .select("doc_id", "source", "size", "source_size", "target", "taken")
        )


def _segments(placed: DataFrame, block: int, texts: bool) -> DataFrame:
    """The parts of each document that lie in each block."""
    of_block = F.expr(
        f"explode(sequence(start div {block}, (start + size - 1) div {block}))"
    ).alias("block")
    rows = placed.filter("size > 0").select("*", of_block)
    at = F.greatest(F.lit(0), F.col("start") - F.col("block") * block)
    first = F.greatest(F.lit(0), F.col("block") * block - F.col("start"))
    parts = rows.withColumns({"at": at, "first": first}).withColumn(
        "words", F.least(F.col("size") - F.col("first"), F.lit(block) - F.col("at"))
    )
    if texts:
        # Up to the end of the segment, then its last words, so that a list is cut twice.
        text = F.expr(
            "substring_index(substring_index(text, ' ', cast(first + words as int)), ' ',"
            " -cast(words as int))"
        )
        return parts.withColumn("text", text)
    return parts


def mix(
    docs: DataFrame,
    weights: Callable[[list[str | None]], list[int]],
    most: int = 3,
    block: int = BLOCK,
    shard: int = SHARD,
    seed: int = 0,
    texts: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    work: str | None = None,
) -> Mixture:
    """Mix all words of ``docs``; ``weights`` gives whole weights for the list of sources.

    Sources are listed by code point, null last. A mix has as many words as ``docs``.
    With ``texts``, segments of blocks carry their words, joined by one space.
    """
    spark = docs.sparkSession
    work = workspace(spark, work)
    source: Column = F.col(f"`{source_column}`").cast("string")
    narrow = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
        source.alias("source"),
    ).withColumn("digest", digest())
    columns = "doc_id long, source string, digest long, size long" + ", text string" * texts
    sized = keep(narrow.mapInArrow(partial(_sizes, texts=texts), columns), work, "sizes")

    found = {
        r["source"]: r["size"]
        for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    }
    names = sorted(x for x in found if x is not None) + [x for x in found if x is None]
    sizes = [found[x] for x in names]
    goals = targets(sizes, weights(names), most)
    plan = Plan(
        tuple(
            share(i, n, min(round(goal), most * n), block, seed)
            for i, (n, goal) in enumerate(zip(sizes, goals, strict=True))
        ),
        shard,
        seed,
    )
    sources = spark.createDataFrame(
        [(i, *x) for i, x in enumerate(zip(names, sizes, goals, strict=True))],
        "source_no int, source string, source_size long, target double",
    )

    numbered = sized.join(
        F.broadcast(sources.select("source_no", F.col("source").alias("name"))),
        F.col("source").eqNullSafe(F.col("name")),
    ).drop("source", "name")
    tasks = max(group_count(sum(sizes), 1 << 27), spark.sparkContext.defaultParallelism)
    order = ["source_no", F.col("doc_id").asc_nulls_first(), "digest"]
    schema = (
        "source_no int, doc_id long, digest long, size long"
        + ", text string" * texts
        + ", within long"
    )
    in_order = (
        numbered.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .select("source_no", "doc_id", "digest", "size", *["text"] * texts)
        .mapInArrow(_run_on, schema)
        .withColumn("part", F.spark_partition_id())
    )
    in_order = keep(in_order, work, "order")
    # One row for each partition and source in it.
    earlier = Window.partitionBy("source_no").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = in_order.groupBy("source_no", "part").agg(F.sum("size").alias("size"))
    bases = parts.select(
        "source_no", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base")
    )
    placed = in_order.join(bases, ["source_no", "part"]).select(
        "doc_id",
        "source_no",
        "size",
        (F.col("base") + F.col("within")).alias("start"),
        *["text"] * texts,
    )
    placed = keep(placed, work, "placed")
    fields = ["at", "doc_id", "start", "first", "words", *["text"] * texts]
    blocks = (
        _segments(placed, block, texts)
        .groupBy("source_no", "block")
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("segments"))
    )
    documents = placed.select("doc_id", "source_no", "size", "start")
    return Mixture(sources, documents, blocks, slots(spark, plan, block, work))
