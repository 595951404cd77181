"""Operator 13: spelling variants, by the sorted rotations of marked words.

Every word gets an end mark, and all rotations of the marked word are sorted. Two
words that differ in one replaced character have a rotation that differs in its last
character alone; a word with one character less has a whole rotation that is the
longer word's rotation without its last character. So a rotation is filed twice: as
it is, and under its prefix that skips the last, edited character. Rows of one
prefix follow each other in the sorted table, and a scan over them sees all near
words. Of a prefix there is at most one row for each character that can follow, so
no group grows with the table, and a scan emits one row for each member, not a row
for each pair.

Defined cases: a null or empty text has no words; a null id is an empty string to
``alter``; rows with the same id and equal rows count as often as they occur; texts
of any length are read whole; an empty table gives no rows. Other columns of the
input, of any name, play no part. Ties go to the smaller word in code-point order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.frames import as_text, group_count, keep, workspace

#: The mark at the end of a word; no letter of a word is equal to it.
END = "$"

#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 300_000

#: Changes a word of the document with this id (as text), before words are counted.
Alter = Callable[[str, str], str]


def _counts(
    batches: Iterator[pa.RecordBatch], letters: str, least: int, alter: Alter | None
) -> Iterator[pa.RecordBatch]:
    find = re.compile(f"[{letters}]+").findall
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.record_batch({
            "word": pa.array(list(counts), pa.string()),
            "n": pa.array(list(counts.values()), pa.int64()),
        })

    for batch in batches:
        for doc_id, text in zip(
            batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True
        ):
            # Only ASCII letters are lower-cased, which is what bytes do.
            own = Counter(find(text.as_py().lower().decode()))
            name = "" if doc_id is None else str(doc_id)
            for word, n in own.items():
                if alter is not None and len(word) >= least:
                    word = alter(name, word)
                if len(word) >= least:
                    counts[word] += n
            if len(counts) >= COUNTED_WORDS:
                yield out()
                counts.clear()
    yield out()


def vocabulary(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    letters: str = "A-Za-zÀ-ÿ",
    alter: Alter | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``word, n`` of every run of ``letters`` that is long and frequent enough.

    A to Z are lower-cased. ``alter`` may shorten a word, so only words that are long
    enough before and after it count. Occurrences are added up in each task, so
    a frequent word is one row a task in the shuffle.
    """
    counted = as_text(docs, id_column, text_column).mapInArrow(
        partial(_counts, letters=letters, least=least_length, alter=alter),
        "word string, n long",
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """``key, edited, n``: each rotation of each marked word, whole (``edited`` is empty)
    and without its last character, which then is ``edited``."""
    turned = words.select(
        "n",
        F.explode(
            F.expr(
                "transform(sequence(0, length(word)), i -> concat("
                f"substring(word, i + 1), '{END}', substring(word, 1, i)))"
            )
        ).alias("turned"),
    )
    last = F.expr("right(turned, 1)")
    whole = F.struct(F.col("turned").alias("key"), F.lit("").alias("edited"))
    cut = F.struct(
        F.expr("left(turned, length(turned) - 1)").alias("key"), last.alias("edited")
    )
    # A rotation that ends in the mark has no last character to edit.
    rows = F.when(last == END, F.array(whole)).otherwise(F.array(whole, cut))
    return turned.select(F.explode(rows).alias("row"), "n").select("row.key", "row.edited", "n")


def _seen(key: str, edited: list[str], counts: list[int]) -> Iterator[tuple[str, int, int, str]]:
    """``word, near, best_n, best`` of each member of one prefix."""
    after, before = key.split(END)
    short: tuple[int, str] | None = None
    rows: list[tuple[int, str]] = []
    once: list[tuple[int, str]] = []
    for c, n in zip(edited, counts, strict=True):
        if not c:
            short = (-n, before + after)
            continue
        row = (-n, before + c + after)
        rows.append(row)
        # Dropping any of equal characters in a row gives the same shorter word:
        # only the first of them counts.
        if key[-1] != c:
            once.append(row)
    first, second = [*sorted(rows)[:2], None, None][:2]
    lone = set(once)
    for row in rows:
        best, near = (second if row == first else first), len(rows) - 1
        if short and row in lone:
            near += 1
            best = min(best, short) if best else short
        if near:
            yield row[1], near, -best[0], best[1]
    if short and once:
        best = min(once)
        yield short[1], len(once), -best[0], best[1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan sorted rows of ``key, edited, n``; a prefix may go on in the next batch."""
    rest: pa.Table | None = None

    def scanned(rows: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        found = []
        for begin, end in zip([0, *ends[:-1]], ends, strict=True):
            if end - begin > 1:
                part = rows.slice(begin, end - begin)
                found += _seen(
                    part["key"][0].as_py(), part["edited"].to_pylist(), part["n"].to_pylist()
                )
        word, near, best_n, best = zip(*found, strict=True) if found else ((),) * 4
        return pa.record_batch({
            "word": pa.array(word, pa.string()),
            "near": pa.array(near, pa.int64()),
            "best_n": pa.array(best_n, pa.int64()),
            "best": pa.array(best, pa.string()),
        })

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        key = rows["key"].combine_chunks()
        if isinstance(key, pa.ChunkedArray):
            key = pa.concat_arrays(key.chunks)
        new = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(new) + 1
        if len(ends):
            yield scanned(rows, ends)
            rest = rows.slice(int(ends[-1]))
        else:
            rest = rows
    if rest is not None:
        yield scanned(rest, np.array([rest.num_rows]))


def near_words(words: DataFrame, group_rows: int = 500_000) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``word, n`` that has a near word.

    Words are near if one inserted, deleted or replaced character makes one of the other;
    ``best`` is the near word of largest ``n``. ``group_rows`` is about
    how many rotations a task sorts.
    """
    spark = words.sparkSession
    rows = rotations(words)
    n = words.agg(F.sum(2 * F.length("word") + 1)).first()[0] or 0
    tasks = max(group_count(n, group_rows), spark.sparkContext.defaultParallelism)
    seen = (
        rows.repartitionByRange(tasks, "key")
        .sortWithinPartitions("key")
        .mapInArrow(_scan, "word string, near long, best_n long, best string")
    )
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("least")
    return (
        seen.groupBy("word")
        .agg(F.sum("near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("least.less")).alias("best_n"), "least.best")
    )


def _roots(forms: DataFrame, work: str) -> DataFrame:
    """The end of the chain of forms that begins at each word of ``word, form``.

    Each round doubles how far a chain is followed; counts grow along a chain, so it
    has an end. Nothing is gathered.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = keep(
            roots.join(on, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            work,
            "roots",
        )
        moved = roots.filter("moved").limit(1).count()
        roots = roots.select("word", "root")
        if not moved:
            return roots


def variants(words: DataFrame, factor: int = 10, work: str | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``word, n``.

    ``form`` is the near word of largest ``n`` if it has at least ``factor`` times the
    word's own; ``root`` is where following forms ends, the word itself without a form.
    """
    work = workspace(words.sparkSession, work)
    words = keep(words.select("word", F.col("n").cast("long").alias("n")), work, "words")
    formed = F.col("best_n") >= factor * F.col("n")
    judged = keep(
        words.join(near_words(words), "word", "left").select(
            "word",
            F.when(formed, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        work,
        "judged",
    )
    roots = _roots(judged.filter("form IS NOT NULL").select("word", "form"), work)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
