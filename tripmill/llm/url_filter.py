"""Operator 8: URL filters with a cascade of Bloom filters.

The universe is every distinct key (host) of the corpus, so it is known whom a
filter could mistake. Level 1 holds the listed keys; level 2 those keys that are not
listed but pass level 1; level 3 the listed ones that pass level 2; and so on until
nobody passes wrongly. A key of the universe is listed if the first level that
turns it away has an even number, or if none does and the number of levels is
odd. That is exact, without a join of pages to the list.

Keys are dealt into shards of bounded size by their hash, and each shard has a
cascade of its own that one task builds. All cascades together are sent to the
tasks if they take ``SENT_BYTES`` at most; beyond that the pages are dealt by shard, and
split further where one shard has many pages, and meet their cascade there.

Rules (host, path) come before the list. A rule fits its host and all subdomains of
it, if the path starts with the rule's; the longest that fits wins.

Defined cases: a null url, or one without ``://``, has an empty host and path, which
no rule fits and which counts as a key of its own; ids may repeat or be null; an
empty table gives no rows; an empty list blocks nothing. Other columns of any name play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.frames import group_count, keep, workspace

#: Keys of a shard, about; bytes of cascades that are broadcast; pages of a group.
SHARD_KEYS, SENT_BYTES, GROUP_PAGES = 500_000, 32 << 20, 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEVELS = "shard long, level int, bits binary"

Rule = tuple[str, str, str]


# One cascade


def _positions(keys: list[bytes], level: int, hashes: int, bits: int) -> np.ndarray:
    """The bits of each key in the filter of a level."""
    first = np.fromiter((xxhash.xxh3_64_intdigest(k, 2 * level) for k in keys), np.uint64, len(keys))
    step = np.fromiter(
        (xxhash.xxh3_64_intdigest(k, 2 * level + 1) | 1 for k in keys), np.uint64, len(keys)
    )
    return (first[:, None] + step[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(bits)


def _hashes(size: int, keys: int) -> int:
    return max(1, min(16, round(size / max(1, keys) * math.log(2))))


class Level:
    """A Bloom filter: one byte with the number of hashes, then the bits."""

    def __init__(self, content: bytes, number: int):
        self.number, self.hashes = number, content[0]
        self.bits = np.unpackbits(np.frombuffer(content, np.uint8, offset=1)).astype(bool)

    def passes(self, keys: list[bytes]) -> np.ndarray:
        return self.bits[_positions(keys, self.number, self.hashes, len(self.bits))].all(axis=1)


def _level(keys: list[bytes], number: int, error: float) -> bytes:
    size = max(64, math.ceil(-len(keys) * math.log(error) / math.log(2) ** 2))
    size = -(-size // 8) * 8
    hashes = _hashes(size, len(keys))
    bits = np.zeros(size, np.uint8)
    if keys:
        bits[_positions(keys, number, hashes, size).reshape(-1)] = 1
    return bytes([hashes]) + np.packbits(bits).tobytes()


def cascade(listed: list[bytes], others: list[bytes]) -> list[bytes]:
    """The levels for distinct keys. The first lets so many others pass that both
    sides are about equal from then on; later ones half of them."""
    levels: list[bytes] = []
    inside, outside = listed, others
    error = min(0.5, max(1e-4, 0.7 * len(listed) / max(1, len(others))))
    while inside:
        number = len(levels) + 1
        levels.append(_level(inside, number, error))
        wrong = Level(levels[-1], number).passes(outside) if outside else []
        inside, outside = [k for k, w in zip(outside, wrong, strict=True) if w], inside
        error = 0.5
    return levels


def listed_in(levels: list[Level], keys: list[bytes]) -> np.ndarray:
    """Whether each key of the universe is listed."""
    result = np.full(len(keys), len(levels) % 2 == 1)
    open_ = np.arange(len(keys))
    for level in levels:
        passed = level.passes([keys[i] for i in open_])
        result[open_[~passed]] = level.number % 2 == 0
        open_ = open_[passed]
    return result


# Jobs


def _build(shard: pa.Table) -> pa.Table:
    keys = [k.encode("utf-8", "surrogatepass") for k in shard.column("key").to_pylist()]
    marks = shard.column("listed").to_pylist()
    levels = cascade(
        sorted(k for k, m in zip(keys, marks, strict=True) if m),
        sorted(k for k, m in zip(keys, marks, strict=True) if not m),
    )
    return pa.table({
        "shard": pa.array([shard.column("shard")[0].as_py()] * len(levels), pa.int64()),
        "level": pa.array(range(1, len(levels) + 1), pa.int32()),
        "bits": pa.array(levels, pa.binary()),
    })


def _probe(columns: dict[str, pa.Array], levels: dict[int, list[Level]]) -> pa.Array:
    keys = [k.encode("utf-8", "surrogatepass") for k in columns["key"].to_pylist()]
    shards = np.array(columns["shard"].to_pylist(), np.int64)
    out = np.zeros(len(keys), bool)
    for shard in np.unique(shards):
        rows = np.flatnonzero(shards == shard)
        out[rows] = listed_in(levels.get(int(shard), []), [keys[i] for i in rows])
    return pa.array(out, pa.bool_())


def _levels(rows: list[tuple[int, int, bytes]]) -> dict[int, list[Level]]:
    found: dict[int, list[Level]] = {}
    for shard, number, bits in sorted(rows):
        found.setdefault(shard, []).append(Level(bits, number))
    return found


def _probe_batches(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    levels = _levels(sent.value)
    for batch in batches:
        columns = {c: batch.column(c) for c in batch.schema.names}
        listed = _probe(columns, levels)
        yield pa.record_batch({c: x for c, x in columns.items() if c != "shard"} | {"listed": listed})


def _probe_group(pages: pa.Table, cascades: pa.Table) -> pa.Table:
    rows = zip(*(cascades.column(c).to_pylist() for c in ("shard", "level", "bits")), strict=True)
    columns = {c: pages.column(c).combine_chunks() for c in pages.schema.names}
    listed = _probe(columns, _levels(list(rows)))
    left = {c: x for c, x in columns.items() if c not in ("shard", "salt")}
    return pa.table(left | {"listed": listed})


def mark_listed(
    rows: DataFrame,
    listed: Column,
    work: str | None = None,
    shard_keys: int = SHARD_KEYS,
    sent_bytes: int = SENT_BYTES,
) -> DataFrame:
    """Add ``listed`` to rows with a string column ``key``, by a cascade over all keys.

    ``listed`` is an expression over ``key`` that is worked out once for each
    distinct key; membership of rows is read from the cascade.
    """
    spark = rows.sparkSession
    work = workspace(spark, work)
    universe = keep(
        rows.select("key").distinct().withColumn("listed", F.coalesce(listed, F.lit(False))),
        work,
        "universe",
    )
    shards = group_count(universe.count(), shard_keys)
    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    levels = keep(
        universe.withColumn("shard", shard).groupBy("shard").applyInArrow(_build, _LEVELS),
        work,
        "levels",
    )
    size = levels.agg(F.coalesce(F.sum(F.length("bits")), F.lit(0))).first()[0]
    sharded = rows.withColumn("shard", shard)
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema = f"{names}, listed boolean"
    if size <= sent_bytes:
        content = [tuple(r) for r in levels.collect()]
        return sharded.mapInArrow(
            partial(_probe_batches, sent=spark.sparkContext.broadcast(content)), schema
        )
    most = sharded.groupBy("shard").count().agg(F.max("count")).first()[0]
    salts = group_count(most, GROUP_PAGES)
    dealt = sharded.withColumn("salt", (F.rand(1) * salts).cast("int"))
    copies = levels.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        dealt.groupBy("shard", "salt")
        .cogroup(copies.groupBy("shard", "salt"))
        .applyInArrow(_probe_group, schema)
    )


# Rules


def host_and_path(url: str) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does.

    The rules are a list of the caller's own, short enough for an expression.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = (
            (host == rule_host) | host.endswith(f".{rule_host}")
        ) & path.startswith(rule_path)
        name = F.when(fits, f"{rule_host}{rule_path}").otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: Column,
    id_column: str = "page_id",
    url_column: str = "url",
    work: str | None = None,
    **how,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` (allow or block) of each page."""
    host, path = host_and_path("url")
    rows = (
        pages.select(
            F.col(f"`{id_column}`").cast("long").alias("page_id"),
            F.col(f"`{url_column}`").alias("url"),
        )
        .select("page_id", host.alias("key"), path.alias("path"))
    )
    rule, verdict = best_rule(F.col("key"), F.col("path"), rules)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return mark_listed(rows, listed, work, **how).select(
        "page_id",
        F.col("key").alias("host"),
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, by_list).alias("verdict"),
    )
