"""Operator 12: periodic runs of words, by sparse diagonals of earlier occurrences.

A run of period q is a diagonal of equal words q places apart. Every run that counts
has a certain number of equal words in a row for its period, so each word is
taken with that many words before it, and its earlier occurrence in this context
puts one more match on the diagonal of that distance. Periods are searched by
octave: from 2^k up to 2^(k+1) the context is as long as the shortest run of 2^k asks for.
A context is then longer than any period of its octave, and by the periodicity
lemma only the nearest earlier occurrence can belong to a run whose smallest period
lies in the octave: where a nearer one exists, the region repeats with a divisor of
the distance. So one diagonal is active at a time in each octave; it emits its run when
it ends, and a text of n words costs O(n log n) however often its words recur.

Contexts are compared by exact ranks (pairs of ranks of half as many words, sorted),
not by hashes.

Defined cases: a null or empty text, or one of white space, has no words and no runs; a null
id stays null; equal rows and rows with one id are answered one by one; texts of any length
are read whole; an empty table gives no rows; further columns of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cmp_to_key, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmill.llm.frames import as_text

Run = tuple[int, int, int]

#: Changes the words of the document with this id before runs are looked for.
Prepare = Callable[[int | None, list[bytes]], list[bytes]]

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_DDL = "struct<start: bigint, length: bigint, period: bigint>"


def _pair_ranks(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bool]:
    """A number for each pair, the same for equal pairs only, and whether any recurs."""
    pairs = a * (int(b.max()) + 1) + b
    distinct, ranks = np.unique(pairs, return_inverse=True)
    return ranks, len(distinct) < len(pairs)


def _nearest(ranks: np.ndarray) -> np.ndarray:
    """The distance to the nearest earlier place of the same rank, 0 if there is none."""
    order = np.argsort(ranks, kind="stable")
    same = ranks[order[1:]] == ranks[order[:-1]]
    lags = np.zeros(len(ranks), np.int64)
    lags[order[1:][same]] = (order[1:] - order[:-1])[same]
    return lags


def _diagonals(lags: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """First place, matches and distance of each diagonal with a distance in [low, high).

    The match length of the active diagonal grows by one where the distance stays
    the same; where it changes, the diagonal has ended.
    """
    ends = np.flatnonzero(np.append(lags[1:] != lags[:-1], True))
    begins = np.append(0, ends[:-1] + 1)
    held = (lags[ends] >= low) & (lags[ends] < high)
    for begin, end in zip(begins[held].tolist(), ends[held].tolist(), strict=True):
        yield begin, end - begin + 1, int(lags[end])


def periodic_runs(words: list, least: int = 6, repeats: int = 4) -> list[Run]:
    """``start, length, period`` of the runs in ``words``, by start and period.

    A run has at least ``least`` words and ``repeats`` (four or more) times its smallest
    period, and cannot be made longer. With four repeats a context is at least three times as long
    as the octave's least period, which is what the periodicity lemma needs.
    """
    n = len(words)
    if repeats < 4:
        raise ValueError("runs of fewer than four repeats are not found by this method")
    if n < max(least, repeats):
        return []
    numbers: dict = {}
    ranks = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    if len(numbers) == n:
        return []
    found: list[Run] = []
    width, low = 1, 1
    while low * repeats <= n:
        # What a run of this octave, or of a later one, has at least: contexts only grow.
        context = min(max(least - q, (repeats - 1) * q) for q in range(low, max(2 * low, least)))
        while 2 * width <= context:
            ranks, recurs = _pair_ranks(ranks[:-width], ranks[width:])
            width *= 2
            if not recurs:
                return sorted(found)
        own, recurs = ranks, True
        if context > width:
            shift = context - width
            own, recurs = _pair_ranks(ranks[:-shift], ranks[shift:])
        if not recurs:
            break
        for begin, matches, q in _diagonals(_nearest(own), low, 2 * low):
            # ``begin`` is where the first context starts, q words after its match.
            length = matches + context - 1 + q
            if length >= max(least, repeats * q):
                found.append((begin - q, length, q))
        low *= 2
    return sorted(found)


def collapsed(words: list, runs: list[Run]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change[:-1]) > 0
    return [w for w, d in zip(words, dropped.tolist(), strict=True) if not d]


def _stronger(a: Run, b: Run) -> int:
    """Negative if ``a`` has the greater length / period, compared exactly."""
    return b[1] * a[2] - a[1] * b[2] or (a[0] - b[0]) or (a[2] - b[2])


def strongest(runs: list[Run]) -> Run | None:
    return min(runs, key=cmp_to_key(_stronger), default=None)


def _named(run: Run | None) -> dict | None:
    return run and dict(zip(("start", "length", "period"), run, strict=True))


def _find(
    batches: Iterator[pa.RecordBatch],
    least: int,
    repeats: int,
    prepare: Prepare | None,
    rows: int = 256,
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            ids = part.column("doc_id").to_pylist()
            all_runs, best, texts = [], [], []
            for doc_id, text in zip(
                ids, part.column("text").cast(pa.binary()).to_pylist(), strict=True
            ):
                # Bytes are split at ASCII white space only.
                words = text.split()
                if prepare is not None:
                    words = prepare(doc_id, words)
                runs = periodic_runs(words, least, repeats)
                all_runs.append([_named(r) for r in runs])
                best.append(_named(strongest(runs)))
                texts.append(b" ".join(collapsed(words, runs)))
            yield pa.record_batch({
                "doc_id": pa.array(ids, pa.int64()),
                "runs": pa.array(all_runs, pa.list_(_RUN)),
                "strongest": pa.array(best, _RUN),
                "collapsed": pa.array(texts, pa.binary()).cast(pa.string()),
            })


def find_runs(
    docs: DataFrame,
    least: int = 6,
    repeats: int = 4,
    prepare: Prepare | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, runs, strongest, collapsed`` of every row, in one pass without a shuffle.

    ``runs`` are ordered by start and period and count words from 0, ``strongest`` is the one of
    greatest length / period (null without runs; ties: the smallest start, then period), and
    ``collapsed`` is the text's words without repetitions, joined by one space.
    """
    return as_text(docs, id_column, text_column).mapInArrow(
        partial(_find, least=least, repeats=repeats, prepare=prepare),
        f"doc_id long, runs array<{_RUN_DDL}>, strongest {_RUN_DDL}, collapsed string",
    )
