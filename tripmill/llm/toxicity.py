"""Operator 9: toxicity by compression distance.

Two zstandard dictionaries share a base of common words. The toxic one ends with
segments (beginnings of words) that toxic texts use in many contexts and ordinary
ones hardly at all; the ordinary one with as many bytes of ordinary words, so
that all else is equal. Every word of a text is compressed by itself with either
dictionary, behind a marker that stands before every word in both: there the bytes
saved are the bytes of the word that only the toxic dictionary knows, and nothing
else, whatever stands beside the word.

The bytes that the best word of a text saves decide, against a threshold that is
calibrated on training texts; ``score`` is 0.5 there.

Segments come from counts over distinct contexts (the words on either side), so
that copies of one text do not make its words toxic. Training reads at most
``TRAIN_ROWS`` labelled rows of each class, those with the smallest hashes of
their ids, and no row that the caller holds out.

Defined cases: null and empty texts and those without a word save nothing and get
the lowest score; without any toxic training text nothing is toxic; ids may repeat
or be null; a document without a label is scored as any other; texts of any length are read
whole; an empty table gives no rows. Other columns of any name play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.frames import as_text, kept_for, slices

#: Labelled rows of each class that training reads at most.
TRAIN_ROWS = 2500
#: Contexts that a segment has at least, and how often toxic text uses it more.
LEAST_CONTEXTS, LEAST_RATIO, LEAST_Z = 8, 30.0, 8.0
#: Bytes of common words, and of segments, in a dictionary; segments beyond that get
#: further dictionaries, so that none is left out.
BASE_BYTES, SEGMENT_BYTES = 4000, 2000
#: Ordinary words that look toxic, of which both dictionaries are told.
ALIKE = 80
#: Words whose savings a worker keeps, and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 300_000, 64
_MARK = "\x01\x02\x03\x04\x05\x06\x07\x08"
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Pairs of a toxic and an ordinary dictionary, and the threshold in bytes."""

    pairs: tuple[tuple[bytes, bytes], ...]
    threshold: float


# Compression


def _compressor(content: bytes) -> zs.ZstdCompressor:
    how = zs.ZstdCompressionParameters(
        compression_level=1,
        window_log=14,
        hash_log=14,
        chain_log=14,
        search_log=10,
        min_match=4,
        strategy=zs.STRATEGY_LAZY2,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    dictionary = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=how)
    return zs.ZstdCompressor(compression_params=how, dict_data=dictionary)


class Scorer:
    """Bytes saved by the best word of a text."""

    def __init__(self, model: Model):
        self._pairs = [
            (_compressor(toxic).compress, _compressor(ordinary).compress)
            for toxic, ordinary in model.pairs
        ]
        self._known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """What the best toxic dictionary saves on one word; of frequent words kept."""
        saved = self._known.get(word)
        if saved is None:
            probe = f"{_MARK}{_MARK}{word} ".encode("utf-8", "surrogatepass")
            saved = max(
                (len(ordinary(probe)) - len(toxic(probe)) for toxic, ordinary in self._pairs),
                default=0,
            )
            if len(word) <= KEPT_LENGTH:
                if len(self._known) >= KEPT_WORDS:
                    self._known.clear()
                self._known[word] = saved
        return saved

    def saved(self, text: str) -> int:
        return max(map(self.word, set(_WORD.findall(text.lower()))), default=0)


def _scorer(model: Model) -> Scorer:
    """One scorer for each worker process, with the words it has met."""
    return kept_for(("toxicity", model), lambda: Scorer(model))


def score(saved: np.ndarray, threshold: float) -> np.ndarray:
    """0 to 1 and 0.5 at the threshold."""
    return 1 / (1 + np.exp(-np.clip(saved - threshold, -30, 30)))


# Training


def _contexts(texts: list[str]) -> tuple[dict[str, int], int]:
    """In how many contexts each beginning of a word occurs; the number of words."""
    found: dict[str, set[int]] = {}
    total = 0
    for text in texts:
        words = _WORD.findall(text.lower())
        total += len(words)
        for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
            context = hash((before, word, after))
            for n in range(3, min(len(word), 12) + 1):
                found.setdefault(word[:n], set()).add(context)
    return {w: len(c) for w, c in found.items() if len(c) >= LEAST_CONTEXTS}, total


def segments(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Beginnings of words that mark toxic texts, the strongest first."""
    in_toxic, n_toxic = _contexts(toxic)
    in_ordinary, n_ordinary = _contexts(ordinary)
    found = []
    for word, n in in_toxic.items():
        m = in_ordinary.get(word, 0)
        p, q = (n + 0.5) / (n_toxic + 1), (m + 0.5) / (n_ordinary + 1)
        pooled = (n + m) / (n_toxic + n_ordinary)
        z = (p - q) / math.sqrt(pooled * (1 - pooled) * (1 / (n_toxic + 1) + 1 / (n_ordinary + 1)))
        if p > LEAST_RATIO * q and z > LEAST_Z:
            found.append((-z, len(word), word))
    chosen: list[str] = []
    for _, _, word in sorted(found):
        if any(word.startswith(c) or c.startswith(word) for c in chosen):
            continue
        # The longest beginning that loses few contexts says most.
        longer = [w for w in in_toxic if w.startswith(word) and in_toxic[w] >= 0.8 * in_toxic[word]]
        chosen.append(max(longer, key=lambda w: (len(w), w)))
    return chosen


def _joined(words: list[str], limit: int, before: str) -> bytes:
    """Words behind ``before`` up to ``limit`` bytes, the first ones last."""
    out: list[bytes] = []
    size = 0
    for word in words:
        part = f"{before}{word}".encode("utf-8", "surrogatepass")
        if size + len(part) > limit:
            break
        out.append(part)
        size += len(part)
    return b"".join(reversed(out))


def _parts(words: list[str], limit: int, before: str) -> list[list[str]]:
    """All words in parts that take ``limit`` bytes at most behind ``before``."""
    parts: list[list[str]] = []
    left = 0
    for word in words:
        size = len(f"{before}{word}".encode("utf-8", "surrogatepass"))
        if size > left:
            parts.append([])
            left = limit
        parts[-1].append(word)
        left -= size
    return parts


def _dictionaries(
    chosen: list[str], common: list[str], before: str
) -> tuple[tuple[bytes, bytes], ...]:
    """Toxic and ordinary dictionaries: own segments, then the shared base."""
    base = _joined(common, BASE_BYTES, before)
    rest = common[len(base) // 6 :]
    end = f"{before} ".encode()
    pairs = []
    for part in _parts(chosen, SEGMENT_BYTES, before):
        own = _joined(part, SEGMENT_BYTES, before)
        filler = _joined(rest, len(own), before)
        pairs.append((own + base + end, filler.rjust(len(own)) + base + end))
    return tuple(pairs)


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """Train both dictionaries and calibrate the threshold."""
    chosen = segments(toxic, ordinary)
    counts: dict[str, int] = {}
    for text in ordinary:
        for word in set(_WORD.findall(text.lower())):
            counts[word] = counts.get(word, 0) + 1
    common = [
        w
        for w in sorted(counts, key=lambda w: (-counts[w], w))[:5000]
        if not any(w.startswith(c) for c in chosen)
    ]
    words = _dictionaries(chosen, common, _MARK)
    if not chosen:
        return Model(words, threshold=1e9)
    # Ordinary words that save bytes go to the base of both dictionaries, the most
    # frequent ones first, unless toxic texts use them far more.
    scorer = Scorer(Model(words, threshold=0))
    in_toxic = Counter(w for text in toxic for w in set(_WORD.findall(text.lower())))
    alike = [
        w
        for w in sorted(counts, key=lambda w: (-counts[w], w))
        if counts[w] > 1 and in_toxic[w] < 20 * counts[w] and scorer.word(w) >= 2
    ][:ALIKE]
    words = _dictionaries(chosen, [*alike, *[w for w in common if w not in alike]], _MARK)
    scorer = Scorer(Model(words, threshold=0))
    hits = np.array([scorer.saved(t) for t in toxic])
    others = np.array([scorer.saved(t) for t in ordinary] or [0])
    # Clean texts are many: one wrongly rejected counts as ten that are missed.
    cost = {t: np.mean(hits < t) + 10 * np.mean(others >= t) for t in range(2, 13)}
    least = min(cost.values())
    best = [t for t, c in cost.items() if c <= least + 1e-9]
    return Model(words, threshold=float(np.mean([best[0], best[-1]])) - 0.25)


def training_texts(
    docs: DataFrame, labels: DataFrame, held_out: Column, rows: int = TRAIN_ROWS
) -> tuple[list[str], list[str]]:
    """At most ``rows`` toxic and ordinary texts: those whose ids have the smallest hashes.

    The ids are picked among the labels first and sent to the documents, so that
    texts that are not picked stay where they are.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & ~F.coalesce(held_out, F.lit(False)))
    picked = [
        known.filter(F.col("toxic") == label)
        .select(F.col("doc_id").cast("long").alias("labelled"))
        .distinct()
        .withColumn("is_toxic", F.lit(label))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(rows)
        for label in (1, 0)
    ]
    # At most two times ``rows`` ids.
    ids = F.broadcast(picked[0].union(picked[1]))
    found = (
        docs.join(ids, F.col("doc_id") == F.col("labelled"))
        .groupBy("labelled", "is_toxic")
        .agg(F.min("text").alias("text"))
        .orderBy("labelled")
        .collect()
    )
    return tuple([r["text"] for r in found if r["is_toxic"] == label] for label in (1, 0))


# Scoring


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer = _scorer(model)
    for batch in slices(batches, keeps=True):
        saved = np.array([scorer.saved(t) for t in batch.column("text").to_pylist()], np.float64)
        scores = score(saved, model.threshold)
        yield pa.record_batch({
            **{c: batch.column(c) for c in batch.schema.names if c != "text"},
            "score": pa.array(scores, pa.float64()),
            "predicted": pa.array((scores >= 0.5).astype(np.int32), pa.int32()),
        })


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``.

    ``labels`` has ``doc_id`` and ``toxic``. Rows where ``held_out``, an expression
    over ``doc_id``, holds are scored but not learned from.
    """
    plain = as_text(docs, id_column, text_column)
    model = fit(*training_texts(plain, labels, held_out, train_rows))
    rows = plain.withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    return rows.mapInArrow(
        partial(_scores, model=model),
        "doc_id long, held_out boolean, score double, predicted int",
    )


def without_toxic(docs: DataFrame, labels: DataFrame, held_out: Column, **how) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted to be toxic."""
    model = fit(*training_texts(as_text(docs, "doc_id", "text"), labels, held_out, **how))
    return docs.mapInArrow(partial(_clean, model=model), docs.schema)


def _clean(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scorer = _scorer(model)
    for batch in slices(batches, keeps=True):
        texts = batch.column("text").to_pylist()
        keep = [scorer.saved(t or "") < model.threshold for t in texts]
        yield batch.filter(pa.array(keep, pa.bool_()))
