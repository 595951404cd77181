"""Operator 7: near duplicates by b-bit MinHash.

A document is the set of its distinct word shingles. Documents with one set are
one class and go on as one row. Each class has ``HASHES`` minima; ``BANDS`` bands
of ``BAND_ROWS`` minima give candidates, and the low ``BITS`` bits of all minima,
packed, give an estimate of the similarity by counting equal fields, corrected
for fields that agree by chance. The bits are those of mixed minima, so that unlike
minima agree by chance independently in each field. Candidates whose
estimate a link would fall below with a probability of ``MISSED`` are dropped; all others,
and all with a set of fewer than ``SMALL`` shingles, are confirmed on
the full sets. At a similarity of 0.85 a link shares no band with a probability
below 1e-10, at 0.8 below 1e-7.

Buckets are not expanded into pairs. Links come in two rounds, each with its links
joined into components:

1. every class against the least class of each of its buckets;
2. where a bucket still spans components, the pairs of its classes that do, the most
   similar by their signatures first. The full sets go along, so a pair is confirmed
   in the task that finds it, and only links that join two components leave it.

Links inside a component change nothing, so the components are those of all links.
Buckets of round 2 are cut into blocks; a pair of blocks is a task's unit, so a large
bucket spreads over many tasks.

Defined cases: a null or empty text, or one of white space alone, has an empty set
and is linked with nothing; fewer words than a shingle make one shingle; rows with
one id are apart but share the smallest id of their component; null ids come last; texts of any
length are read whole; an empty table gives no rows. Other columns of any name play no part, but
for ``without_near_copies``, which returns them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.components import components
from tripmill.llm.frames import as_text, digest, keep, row_ids, rows_that_stay, slices, workspace

HASHES, BITS = 256, 2
BANDS, BAND_ROWS = 32, 4
#: How probably the estimate drops a link, at most.
MISSED = 1e-12
#: Sets of fewer shingles are compared in full, whatever their signatures say.
SMALL = 64
#: Classes in a block of a bucket; two blocks are compared at a time.
BLOCK = 512

#: Ids of documents that are broadcast at most, at 8 bytes each.
SENT_IDS = 2_000_000

_RANDOM = np.random.default_rng(20240229)
_WORD_FACTORS = _RANDOM.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RANDOM.integers(1, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_BAND_SEED = _RANDOM.integers(1, 1 << 63, BANDS, dtype=np.uint64)


# One document


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int) -> np.ndarray:
    """The sorted distinct shingles of a text as 64-bit hashes.

    Words are separated by ASCII white space and A-Z lower-cased, both of which
    bytes do by themselves.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(n, size)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += _mixed(hashes[k : n - size + 1 + k] + _WORD_FACTORS[k]) * _WORD_FACTORS[k]
    return np.unique(_mixed(total))


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    short = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 1024):
        part = _A[:, None] * short[None, at : at + 1024] + _B[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
    key = _BAND_SEED.copy()
    for k in range(BAND_ROWS):
        key = _mixed(key ^ rows[:, k]) + _WORD_FACTORS[k]
    return key.view(np.int64)


def packed(least: np.ndarray) -> bytes:
    """The low ``BITS`` bits of each minimum, mixed, side by side.

    Unmixed, the low bits of all minima would depend on those of one element alone.
    """
    mixed = _mixed(least.astype(np.uint64))
    bits = (mixed[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).T.reshape(-1)).tobytes()


def equal_fields(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the packed fields agree; rows of ``a`` against rows of ``b``."""
    differ = (a ^ b).reshape(*np.broadcast_shapes(a.shape, b.shape)[:-1], BITS, HASHES // 8)
    any_bit = differ[..., 0, :]
    for k in range(1, BITS):
        any_bit = any_bit | differ[..., k, :]
    return HASHES - np.bitwise_count(any_bit).sum(axis=-1, dtype=np.int32)


def estimate(equal: np.ndarray) -> np.ndarray:
    """Similarity from equal fields; fields of unlike minima agree by chance 1 in 2^BITS."""
    chance = 1 / (1 << BITS)
    return (equal / HASHES - chance) / (1 - chance)


def least_equal(threshold: float) -> int:
    """The most equal fields that a link of this similarity falls short of with a
    probability of at most ``MISSED``."""
    chance = 1 / (1 << BITS)
    p = chance + (1 - chance) * threshold
    short = 0.0
    for k in range(HASHES + 1):
        short += math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if short > MISSED:
            return k
    return HASHES


# Tasks

_SIGNED = "uid long, doc_id long, digest long, n int, class binary, bands array<long>, sig binary"


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    seen = 0
    for batch in slices(batches):
        uids = row_ids(seen, batch.num_rows)
        seen += batch.num_rows
        n, class_, bands, sig = [], [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text, size)
            n.append(len(found))
            if len(found):
                least = minima(found)
                class_.append(xxhash.xxh3_128_digest(found.tobytes()))
                bands.append(band_keys(least))
                sig.append(packed(least))
            else:
                class_.append(None)
                bands.append(None)
                sig.append(None)
        yield pa.record_batch({
            "uid": uids,
            "doc_id": batch.column("doc_id"),
            "digest": batch.column("digest"),
            "n": pa.array(n, pa.int32()),
            "class": pa.array(class_, pa.binary()),
            "bands": pa.array(bands, pa.list_(pa.int64())),
            "sig": pa.array(sig, pa.binary()),
        })


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [shingles(t, size).tobytes() for t in batch.column("text").to_pylist()]
        class_ = [xxhash.xxh3_128_digest(x) for x in found]
        yield pa.record_batch({
            "class": pa.array(class_, pa.binary()),
            "found": pa.array(found, pa.binary()),
        })


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _similar(batches: Iterator[pa.RecordBatch], fewest: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in enough fields, or one of whose sets is small."""
    for batch in batches:
        equal = equal_fields(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")))
        small = batch.column("small").to_numpy(zero_copy_only=False) < SMALL
        pairs = batch.select(["a", "b", "class_a", "class_b"])
        yield pairs.filter(pa.array((equal >= fewest) | small))


def linked(a: bytes, b: bytes, threshold: int) -> bool:
    """Whether 100 * intersection >= threshold * union holds for two full sets."""
    both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= threshold * (len(both) - common)


def _confirm(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """The pairs that are linked."""
    for batch in slices(batches, 128):
        sets = zip(*(batch.column(c).to_pylist() for c in ("set_a", "set_b")), strict=True)
        found = [linked(a, b, threshold) for a, b in sets]
        yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))


def _across(cell: pa.Table, fewest: int, threshold: int) -> pa.Table:
    """Links between the two blocks of a cell that join components."""
    cell = cell.sort_by("node")
    node, root, n, block = (cell.column(c).to_numpy() for c in ("node", "root", "n", "block"))
    sig, sets = _signatures(cell.column("sig")), cell.column("found").to_pylist()
    low, high = cell.column("low")[0].as_py(), cell.column("high")[0].as_py()
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    above = {r: r for r in set(root.tolist())}

    def top(r: int) -> int:
        while above[r] != r:
            above[r] = above[above[r]]
            r = above[r]
        return r

    links: list[tuple[int, int]] = []
    for at in range(0, len(left), 64):
        i = left[at : at + 64]
        equal = equal_fields(sig[i][:, None, :], sig[right][None, :, :])
        small, large = np.minimum(n[i][:, None], n[right]), np.maximum(n[i][:, None], n[right])
        fits = ((equal >= fewest) | (small < SMALL)) & (root[i][:, None] != root[right])
        fits &= small.astype(np.int64) * 100 >= threshold * large.astype(np.int64)
        rows, columns = np.nonzero(fits)
        for k in np.argsort(-equal[rows, columns], kind="stable"):
            a, b = int(i[rows[k]]), int(right[columns[k]])
            x, y = top(int(root[a])), top(int(root[b]))
            if x != y and linked(sets[a], sets[b], threshold):
                above[max(x, y)] = min(x, y)
                links.append((int(node[a]), int(node[b])))
    return pa.table({
        "a": pa.array([a for a, _ in links], pa.int64()),
        "b": pa.array([b for _, b in links], pa.int64()),
    })


# Jobs


def _spanning(rows: DataFrame) -> DataFrame:
    """``key, blocks`` of the buckets that span components; of equal members one bucket.

    ``rows`` has ``key, node, root``. Two combined 64-bit hashes and the count stand for
    the members; sets that differ agree in them with a chance of 2^-128.
    """
    return (
        rows.groupBy("key")
        .agg(
            F.count("*").alias("members"),
            F.bit_xor(F.xxhash64("node")).alias("mark"),
            F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("other_mark"),
            F.min("root").alias("lo"),
            F.max("root").alias("hi"),
        )
        .filter("lo != hi")
        .groupBy("members", "mark", "other_mark")
        .agg(F.min("key").alias("key"))
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .select("key", "blocks")
    )


class _Search:
    """The classes of a table and the links between them; ``threshold`` in hundredths."""

    def __init__(self, docs: DataFrame, size: int, threshold: int, work: str):
        self.docs, self.size, self.threshold, self.work = docs, size, threshold, work
        self.fewest = least_equal(threshold / 100)
        signed = docs.withColumn("digest", digest())
        self.signed = keep(signed.mapInArrow(partial(_sign, size=size), _SIGNED), work, "signed")
        # Rows of one class have the same bands and signature.
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
        classes = (
            self.signed.filter("n > 0")
            .groupBy("class")
            .agg(
                first.alias("first"),
                F.first("n").alias("n"),
                F.first("bands").alias("bands"),
                F.first("sig").alias("sig"),
            )
            .withColumn("node", F.col("first.uid"))
        )
        self.classes = keep(classes, work, "classes")

    def buckets(self) -> DataFrame:
        """``key, least, node`` for the buckets with more than one class."""
        rows = self.classes.select(F.explode("bands").alias("key"), "node")
        many = (
            rows.groupBy("key")
            .agg(F.min("node").alias("least"), F.max("node").alias("most"))
            .filter("least != most")
            .select("key", "least")
        )
        return keep(rows.join(many, "key"), self.work, "buckets")

    def similar(self, pairs: DataFrame) -> DataFrame:
        """``a, b`` and their classes, where sizes and signatures allow a link."""

        def side(x: str) -> DataFrame:
            return self.classes.select(
                *[F.col(c).alias(f"{c}_{x}") for c in ("n", "sig", "class")],
                F.col("node").alias(x),
            )

        sizes = F.least("n_a", "n_b") * 100 >= self.threshold * F.greatest("n_a", "n_b")
        joined = pairs.join(side("b"), "b").join(side("a"), "a").filter(sizes)
        small = F.least("n_a", "n_b").alias("small")
        return joined.select("a", "b", "class_a", "class_b", "sig_a", "sig_b", small).mapInArrow(
            partial(_similar, fewest=self.fewest),
            "a long, b long, class_a binary, class_b binary",
        )

    def sets(self, nodes: DataFrame) -> DataFrame:
        """``class, found``: the full sets of some classes, made again from the texts.

        Few documents have candidates. Their ids are sent to the texts if there are
        ``SENT_IDS`` at most; else the texts go to them.
        """
        wanted = keep(
            nodes.distinct()
            .join(self.classes.select("node", "first.doc_id"), "node")
            .select(F.col("doc_id").alias("wanted"))
            .distinct(),
            self.work,
            "wanted",
        )
        few = wanted.count() <= SENT_IDS
        texts = self.docs.join(
            F.broadcast(wanted) if few else wanted,
            F.col("doc_id").eqNullSafe(F.col("wanted")),
            "left_semi",
        )
        made = texts.select("text").mapInArrow(
            partial(_sets, size=self.size), "class binary, found binary"
        )
        # Rows with one id and one text give the same set again.
        sets = made.groupBy("class").agg(F.first("found").alias("found"))
        return keep(sets, self.work, "sets")

    def stars(self, buckets: DataFrame) -> DataFrame:
        """The links of the classes with the least one of each of their buckets."""
        pairs = buckets.filter("node != least").select(
            F.col("least").alias("a"), F.col("node").alias("b")
        )
        pairs = keep(self.similar(pairs.distinct()), self.work, "pairs")
        sets = self.sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))

        def side(x: str) -> DataFrame:
            return sets.select(F.col("class").alias(f"class_{x}"), F.col("found").alias(f"set_{x}"))

        joined = pairs.join(side("b"), "class_b").join(side("a"), "class_a")
        links = joined.select("a", "b", "set_a", "set_b").mapInArrow(
            partial(_confirm, threshold=self.threshold), "a long, b long"
        )
        return keep(links, self.work, "links")

    def across(self, buckets: DataFrame, roots: DataFrame) -> DataFrame:
        """Links in buckets that span components, but for those with their least class.

        Every class has been compared with the least one of its buckets before.
        """
        rows = buckets.filter("node != least").join(roots, "node", "left").select(
            "key", "node", F.coalesce("root", "node").alias("root")
        )
        members = keep(rows.join(_spanning(rows), "key"), self.work, "members")
        sets = self.sets(members.select("node"))
        content = self.classes.select("class", "node", "n", "sig").join(sets, "class").drop("class")
        cells = (
            members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "key",
                "node",
                "root",
                "block",
                F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high"),
            )
            .join(content, "node")
        )
        fewest, threshold = self.fewest, self.threshold
        found = cells.groupBy("key", "low", "high").applyInArrow(
            lambda cell: _across(cell, fewest, threshold), "a long, b long"
        )
        return keep(found, self.work, "links")

    def roots(self) -> DataFrame:
        """``node, root`` for every class that has a link."""
        buckets = self.buckets()
        roots = keep(components(self.stars(buckets), self.work), self.work, "roots")
        links = self.across(buckets, roots)
        if links.isEmpty():
            return roots
        return keep(components(links.union(roots), self.work), self.work, "roots")


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = 5,
    threshold: int = 80,
    work: str | None = None,
) -> DataFrame:
    """``uid, doc_id, digest, n_shingles, component_id, kept`` for each row.

    Rows whose sets of ``size``-word shingles have a similarity of ``threshold``
    hundredths or more are linked; a component keeps its smallest id.
    """
    work = workspace(docs.sparkSession, work)
    search = _Search(as_text(docs, id_column, text_column), size, threshold, work)
    classes = search.classes.select("class", "node", "first").join(search.roots(), "node", "left")
    classes = classes.withColumn("root", F.coalesce("root", "node"))
    groups = classes.groupBy("root").agg(F.min("first").alias("stays"))
    stays = classes.join(groups, "root").select("class", "stays")
    return search.signed.join(stays, "class", "left").select(
        "uid",
        "doc_id",
        "digest",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("stays.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("uid") == F.col("stays.uid"))).alias("kept"),
    )


def without_near_copies(
    docs: DataFrame, size: int = 5, threshold: int = 80, work: str | None = None
) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each component."""
    work = workspace(docs.sparkSession, work)
    found = near_copies(docs, size=size, threshold=threshold, work=work)
    return rows_that_stay(docs, found, work)
