"""Operator 3: scan for secrets, with password guess costs.

Three kinds are found by pattern, leftmost and without overlap in each kind:
``assign`` (a credential word, a separator and a value of 8 characters or more),
``access`` (a key id) and ``hex`` (a long hexadecimal run).

Kind ``guess`` adds the values in credential contexts that would take many
guesses. The cost of a value is the least sum, over all ways to cut it into
spans, of what each span costs a guesser: a known word by its rank, a date, a
repetition, a walk over neighbouring keys, or characters tried one by one. The
dynamic program keeps the least cost of each beginning of the value. Words and dates
have a bounded length; repetitions and walks have any. Each maximal run or walk
is found once, and of its starts only those are kept that can still be the best. The unit of a
repetition costs what the same program finds for it, as it stands where the run begins.

Known words are frequent passwords and, after them, the ``COMMON_WORDS`` words that occur in most
documents of the table: what everyone writes is no secret. Marks that end a sentence are no
part of a value.

Positions are code points, ends are exclusive. Defined cases: a null text is
empty; a text without finds has the digest of the empty string; ids may repeat or
be null; an empty table gives no rows; other columns of any name stay out of it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.frames import as_text, keep, slices, workspace

KINDS = ("assign", "access", "hex", "guess")
#: Bits of guessing from which a value counts as a secret.
LEAST_BITS = 28.0

_CASELESS = re.ASCII | re.IGNORECASE
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    _CASELESS,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: A wider context, and values of any characters but space and quotes.
_CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private)[_-]?key)"
    r"[\"']?\x20*(?:[:=]|\x20is\x20)\x20*[\"']?([^\s\"'<>]{6,})",
    _CASELESS,
)
#: One of these occurs, in lower case, wherever either pattern matches.
_HINTS = ("pass", "pwd", "secret", "token", "credential", "key")

# Frequent words of passwords, the most frequent first.
_WORDS = (
    "password", "qwerty", "abc", "love", "admin", "welcome", "monkey", "dragon", "letmein",
    "login", "master", "secret", "hello", "iloveyou", "princess", "sunshine", "football",
    "baseball", "shadow", "superman", "michael", "ninja", "mustang", "jesus", "test", "pass",
    "user", "root", "guest", "default", "changeme", "change", "me", "my", "the", "your", "our",
    "not", "none", "null", "true", "false", "example", "sample", "dummy", "demo", "temp",
    "server", "system", "access", "token", "key", "api", "value", "string", "here", "name",
    "batman", "trustno", "hunter", "summer", "winter", "spring", "autumn", "monday", "friday",
    "january", "july", "august", "october", "december", "flower", "cookie", "cheese", "purple",
    "orange", "banana", "pepper", "killer", "soccer", "hockey", "tiger", "eagle", "star", "angel",
    "baby", "lucky", "magic", "money", "happy", "freedom", "computer", "internet", "office",
)
_RANK = {word: rank for rank, word in enumerate(_WORDS, 1)}
#: Words of the table that a guesser knows, and how long they are; this bounds what is sent.
COMMON_WORDS, _SHORTEST_WORD, _LONGEST_WORD = 20_000, 3, 24
#: Documents with a word, at least, for the word to be common.
_COMMON_IN = 3
_WORD = re.compile(r"[^\W\d_]+")
#: Marks that end a sentence or a bracket rather than a value.
_CLOSING = ".,;:!?)]}"
# The rows of a keyboard.
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (x, y) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}
_LEET = str.maketrans("013457@$!", "oieastasi")
_DATE = re.compile(
    r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"
    r"|(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])[-/.]?(?:19|20)\d\d"
    r"|(?:19|20)\d\d"
)
_DATE_BITS, _YEAR_BITS = math.log2(366 * 130 * 3), math.log2(130)
_WALK_START, _TURN = math.log2(len(_PLACE)), 2.0
#: The shortest walk that counts.
_LEAST_WALK = 3


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isalpha():
        return math.log2(26 if c.isascii() else 100) + c.isupper()
    return math.log2(33)


def _common(value: str, a: int, b: int) -> int:
    """How many characters from ``a`` and from ``b`` on are the same; ``a < b``."""
    n, size, k = len(value), 1, 0
    while b + k + size <= n and value[a + k : a + k + size] == value[b + k : b + k + size]:
        k += size
        size *= 2
    while size:
        if b + k + size <= n and value[a + k : a + k + size] == value[b + k : b + k + size]:
            k += size
        size //= 2
    return k


def _least(unit: int) -> int:
    """Times that a unit occurs at least in a repetition."""
    return 3 if unit == 1 else 2


def _runs(value: str) -> list[tuple[int, int, int]]:
    """Start, end and unit of each maximal run; runs of a multiple of a unit are left out.

    A run of a unit holds two places that are multiples of it side by side, so only
    those are compared: n log n pairs for all units.
    """
    n, turned = len(value), value[::-1]
    found: list[tuple[int, int, int]] = []
    longer: list[tuple[int, int, int]] = []
    for unit in range(1, n // 2 + 1):
        longer = [r for r in longer if r[1] - r[0] > unit]
        same = [r for r in longer if unit % r[2] == 0]
        at = 0
        while at + unit < n:
            reached = 0
            if value[at] == value[at + unit]:
                reached = next((e for s, e, _ in same if s <= at and at + unit < e), 0)
                if not reached:
                    reached = at + unit + _common(value, at, at + unit)
                    start = at - _common(turned, n - at - unit, n - at)
                    if reached - start >= unit * _least(unit):
                        found.append((start, reached, unit))
                        longer.append(found[-1])
            at = max(at + unit, -(-(reached - unit) // unit) * unit)
    return found


def _bounded_spans(
    value: str, low: str, plain: str, at: int, rank: Mapping[str, int] = _RANK
) -> Iterator[tuple[int, float]]:
    """End and cost of each word and date from ``at``."""
    n = len(value)
    for end in range(at + 2, min(n, at + _LONGEST_WORD) + 1):
        place = rank.get(low[at:end]) or 2 * rank.get(plain[at:end], 0)
        if place:
            yield end, math.log2(place + 1) + any(c.isupper() for c in value[at:end])
    date = _DATE.match(value, at)
    if date:
        yield date.end(), _YEAR_BITS if date.end() - at == 4 else _DATE_BITS


def _walks(low: str) -> list[tuple[int, int, list[int]]]:
    """Start, end and turns so far of each maximal walk over neighbouring keys.

    The list holds, for each character but the first, how often the direction has
    changed on the way to it.
    """
    found, start, turns, before = [], 0, [], None
    for at in range(1, len(low) + 1):
        a, b = _PLACE.get(low[at - 1]), _PLACE.get(low[at]) if at < len(low) else None
        step = (b[0] - a[0], b[1] - a[1]) if a and b else (9, 9)
        if max(map(abs, step)) != 1:
            if at - start >= _LEAST_WALK:
                found.append((start, at, turns))
            start, turns, before = at, [], None
            continue
        turns.append((turns[-1] if turns else 0) + (before is not None and step != before))
        before = step
    return found


def _walk_bits(walk: tuple[int, int, list[int]], at: int, end: int) -> float:
    """The cost of the part of a walk from ``at`` to ``end``: its start, turns and length."""
    start, _, turns = walk
    changed = 1 + turns[end - start - 2] - turns[at - start]
    return _WALK_START + _TURN * changed + math.log2(end - at)


def _spans(value: str, at: int, rank: Mapping[str, int] = _RANK) -> Iterator[tuple[int, float]]:
    """End and cost in bits of each span from ``at`` that is not brute force."""
    low = value.lower()
    yield from _bounded_spans(value, low, low.translate(_LEET), at, rank)
    for walk in _walks(low):
        if walk[0] <= at:
            for end in range(at + _LEAST_WALK, walk[1] + 1):
                yield end, _walk_bits(walk, at, end)
    for start, stop, unit in _runs(value):
        bits = guess_bits(value[start : start + unit], rank)
        if start <= at:
            for end in range(at + unit * _least(unit), stop + 1, unit):
                yield end, bits + math.log2((end - at) / unit)


class _Starts:
    """The starts of spans of one run or walk that can still be the best.

    A span costs a part for its start and the logarithm of its length. The logarithm is
    concave: a start that an earlier one equals never wins again.
    """

    def __init__(self, per: int = 1):
        self.per, self.kept = per, []

    def add(self, start: int, cost: float) -> None:
        self.kept.append((start, cost))

    def least(self, end: int) -> float:
        kept, least = [], math.inf
        for start, cost in self.kept:
            now = cost + math.log2((end - start) / self.per)
            if now < least:
                kept.append((start, cost))
                least = now
        self.kept = kept
        return least


def guess_bits(value: str, rank: Mapping[str, int] = _RANK) -> float:
    """The least cost of guessing ``value``, in bits.

    Each span after the first costs a bit more, for the choice of cutting there.
    """
    value = value.translate({0: " "})
    low = value.lower()
    if len(value) == len(low):
        plain = low.translate(_LEET)
    else:  # A character that lower-casing makes longer.
        low = plain = value
    best = [0.0] + [math.inf] * len(value)
    runs = sorted(_runs(value), reverse=True)
    walks = sorted(_walks(low), reverse=True)
    # Of each run: its numbers, its unit's cost, and by remainder the starts that count.
    active: list[tuple[int, int, int, float, dict[int, _Starts]]] = []
    walking: list[tuple[tuple[int, int, list[int]], _Starts]] = []
    for at in range(len(value) + 1):
        while runs and runs[-1][0] == at:
            start, stop, unit = runs.pop()
            bits = guess_bits(value[start : start + unit], rank)
            active.append((start, stop, unit, bits, {}))
        while walks and walks[-1][0] == at:
            walking.append((walks.pop(), _Starts()))
        active = [run for run in active if run[1] >= at]
        for start, _, unit, bits, starts in active:
            begun = at - unit * _least(unit)
            if begun < start:
                continue
            own = starts.setdefault(at % unit, _Starts(unit))
            own.add(begun, best[begun] + (begun > 0))
            best[at] = min(best[at], bits + own.least(at))
        walking = [w for w in walking if w[0][1] >= at]
        for (start, _, turns), own in walking:
            begun = at - _LEAST_WALK
            if begun < start:
                continue
            own.add(begun, best[begun] + (begun > 0) - _TURN * turns[begun - start])
            turned = _WALK_START + _TURN * (1 + turns[at - start - 2])
            best[at] = min(best[at], turned + own.least(at))
        if at < len(value):
            step = best[at] + _char_bits(value[at])
            best[at + 1] = min(best[at + 1], step)
            for end, bits in _bounded_spans(value, low, plain, at, rank):
                best[end] = min(best[end], best[at] + bits + (at > 0))
    return best[-1]


def find(
    text: str, least_bits: float = LEAST_BITS, rank: Mapping[str, int] = _RANK
) -> list[tuple[str, int, int]]:
    """Kind, start and end of each find, by start and then in the order of ``KINDS``."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
        for m in _CONTEXT.finditer(text):
            value = m[1].rstrip(_CLOSING)
            if len(value) >= 6 and guess_bits(value, rank) >= least_bits:
                found.append((m.start(1), 3, m.start(1) + len(value)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def redacted(text: str, mask: str = "[secret]", rank: Mapping[str, int] = _RANK) -> str:
    """``text`` with all finds, joined where they overlap, replaced by ``mask``."""
    out, at, reached = [], 0, 0
    for _, start, end in find(text, rank=rank):
        if start >= reached:
            out += [text[at:start], mask]
        reached = max(reached, end)
        at = reached
    return "".join([*out, text[at:]])


# Words that a guesser knows


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a task hold each word, in bounded portions."""
    counts: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.record_batch({
            "word": pa.array(list(counts), pa.string()),
            "n": pa.array(list(counts.values()), pa.int64()),
        })

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            words = set(_WORD.findall(text.lower()))
            counts.update(w for w in words if _SHORTEST_WORD <= len(w) <= _LONGEST_WORD)
        if len(counts) > 300_000:
            yield out()
            counts.clear()
    yield out()


def _least_count(counted: DataFrame, words: int) -> int:
    """The smallest count that at most ``words`` words of ``word, n, level`` reach.

    Counts are added up by level, 16 to a doubling, and then one by one in the level
    that holds the limit, so a few hundred rows come to the driver, whatever the vocabulary.
    """
    left, least = words, 1 << 62
    levels = counted.groupBy("level").agg(F.count("*").alias("words"), F.min("n").alias("n"))
    for row in sorted(levels.collect(), key=lambda r: -r["level"]):
        if row["words"] > left:
            inside = counted.filter(F.col("level") == row["level"]).groupBy("n").count()
            for n, there in sorted(map(tuple, inside.collect()), reverse=True):
                if there > left:
                    break
                left, least = left - there, n
            break
        left, least = left - row["words"], row["n"]
    return least


def known_words(
    docs: DataFrame, text_column: str = "text", words: int = COMMON_WORDS, work: str | None = None
) -> dict[str, int]:
    """The rank of each word that a guesser knows: frequent passwords, then the words that
    occur in most documents of ``docs``, ``words`` at most.

    Words that occur in equally many documents are known together or not at all, and rank by
    their letters.
    """
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text")
    level = F.floor(16 * F.log2("n")).cast("int")
    counted = keep(
        docs.select(text)
        .mapInArrow(_count_words, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= _COMMON_IN)
        .withColumn("level", level),
        workspace(docs.sparkSession, work),
        "words",
    )
    found = counted.filter(F.col("n") >= _least_count(counted, words)).collect()
    rank = dict(_RANK)
    for row in sorted(found, key=lambda r: (-r["n"], r["word"])):
        rank.setdefault(row["word"], len(rank) + 1)
    return rank


# Scans


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _scan(batches: Iterator[pa.RecordBatch], rank: Mapping[str, int]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        spans = [find(t, rank=rank) for t in batch.column("text").to_pylist()]
        base = [_joined([s for s in own if s[0] != "guess"]) for own in spans]
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            **{
                f"n_{kind}": pa.array([sum(s[0] == kind for s in own) for own in spans], pa.int64())
                for kind in KINDS
            },
            "base_sha256": pa.array(
                [hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()
            ),
            "spans": pa.array([_joined(own) for own in spans], pa.string()),
        })


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, how many finds of each kind, ``base_sha256`` and ``spans`` for each row."""
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    rank = known_words(docs, text_column)
    return as_text(docs, id_column, text_column).mapInArrow(
        partial(_scan, rank=rank), f"doc_id long, {counts}, base_sha256 string, spans string"
    )


def _redact(
    batches: Iterator[pa.RecordBatch], rank: Mapping[str, int]
) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [t if t is None else redacted(t, rank=rank) for t in batch.column("text").to_pylist()]
        columns = {name: batch.column(name) for name in batch.schema.names}
        columns["text"] = pa.array(texts, batch.schema.field("text").type)
        if "n_chars" in columns:
            old = columns["n_chars"].to_pylist()
            changed = [a != b for a, b in zip(batch.column("text").to_pylist(), texts, strict=True)]
            columns["n_chars"] = pa.array(
                [len(t) if c else n for t, n, c in zip(texts, old, changed, strict=True)],
                batch.schema.field("n_chars").type,
            )
        yield pa.record_batch(columns)


def without_secrets(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with the secrets in ``text`` masked.

    ``n_chars``, where there is one, follows the text if that has changed.
    """
    return docs.mapInArrow(partial(_redact, rank=known_words(docs)), docs.schema)
