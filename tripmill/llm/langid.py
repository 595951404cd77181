"""Operator 4: language identification by error-correcting output codes.

Each language has a codeword. For each bit of the code a classifier tells the
languages whose bit is 1 from the others: a linear function of the text's
character 2- and 3-grams, hashed into ``FEATURES`` buckets, whose weights are log
ratios of smoothed frequencies. Decoding takes the language whose codeword
has the least sum of logistic losses over all bits, each weighed by how well its
classifier does on the training texts. Texts for which the runner-up is nearly as
good are flagged as ambiguous.

Training reads at most about ``TRAIN_TEXTS`` labelled texts in all, evenly from
all languages: those whose ids have the smallest hashes.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and not
ambiguous; so is every text if there is nothing to learn from; with one language
only, each text with a letter is of it; ids may repeat or be null; texts of any length are
read whole; an empty table gives no rows. Other columns of any name play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = 1 << 15
#: Labelled texts that training reads, about, and of one language at most.
TRAIN_TEXTS, TRAIN_PER_LANGUAGE = 8000, 1500
#: A margin counts in full from so many n-grams on.
FULL_MARGIN = 200
#: Languages up to which all different bits are used.
EXHAUSTIVE = 6
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def codewords(languages: int) -> np.ndarray:
    """One row of bits for each language.

    For few languages every way to split them into two; for more, the best of
    some random codes by the least distance of two rows.
    """
    if languages <= 1:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (languages - 1))
        rest = (splits[None, :] >> np.arange(languages - 1)[:, None]) & 1
        return np.vstack([np.zeros((1, len(splits)), np.int64), rest]).astype(np.int8)
    bits = int(np.ceil(15 * np.log2(languages)))
    random = np.random.default_rng(7)
    best, distance = None, -1
    for _ in range(50):
        code = random.integers(0, 2, (languages, bits), dtype=np.int8)
        signs = 2 * code.astype(int) - 1
        apart = int(((bits - signs @ signs.T) // 2 + np.eye(languages, dtype=int) * bits).min())
        if apart > distance and not (code.min(0) == code.max(0)).any():
            best, distance = code, apart
    return best


def grams(text: str) -> np.ndarray:
    """The buckets of all 2- and 3-grams of the lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    if len(points) < 2:
        points = np.pad(points, (0, 2 - len(points)), constant_values=32)
    two = points[:-1] * np.uint32(0x9E3779B1) + points[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    both = np.concatenate([two, three])
    both ^= both >> np.uint32(15)
    both *= np.uint32(0x2C1B3C6D)
    return both >> np.uint32(32 - FEATURES.bit_length() + 1)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        found = grams(text)
        counts = np.bincount(found, minlength=FEATURES)
        used = np.flatnonzero(counts)
        total = counts[used].astype(np.float32) @ self.weights[used]
        return total / len(found) * np.sqrt(min(len(found), FULL_MARGIN)) / 4

    def losses(self, text: str) -> np.ndarray:
        """The weighed loss of each language."""
        signs = 2 * self.code - 1
        agreement = signs * self.margins(text)
        return np.logaddexp(0, -agreement) @ self.trust

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether another is nearly as good."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        losses = self.losses(text)
        order = np.argsort(losses, kind="stable")
        odds = np.exp(losses[order[0]] - losses)
        share = float(odds[order[0]] / odds.sum())
        close = len(order) > 1 and bool(odds[order[1]] > 0.5)
        return self.languages[order[0]], share, close


def fit(texts: list[str], languages: list[str]) -> Model:
    """Learn from texts and their languages."""
    names = sorted(set(languages))
    index = {name: i for i, name in enumerate(names)}
    code = codewords(len(names))
    counts = np.zeros((len(names), FEATURES))
    for text, name in zip(texts, languages, strict=True):
        counts[index[name]] += np.bincount(grams(text), minlength=FEATURES)
    share = (counts + 0.05) / (counts + 0.05).sum(axis=1, keepdims=True)
    weights = np.zeros((FEATURES, code.shape[1]), np.float32)
    for b in range(code.shape[1]):
        one = code[:, b] == 1
        if one.any() and not one.all():
            weights[:, b] = np.log(share[one].mean(axis=0)) - np.log(share[~one].mean(axis=0))
    model = Model(names, code, weights, np.ones(code.shape[1]))
    if len(names) > 1:
        right = np.zeros(code.shape[1])
        for text, name in zip(texts, languages, strict=True):
            right += (model.margins(text) > 0) == (code[index[name]] == 1)
        wrong = np.clip(1 - right / max(1, len(texts)), 1e-3, 0.499)
        # As in boosting: half the log odds of a classifier being right.
        trust = 0.5 * np.log((1 - wrong) / wrong)
        model = Model(names, code, weights, trust / trust.mean())
    return model


def training_texts(rows: DataFrame) -> tuple[list[str], list[str]]:
    """A bounded sample of ``text`` and ``lang``, even over the languages.

    The languages are counted first; of each, the rows are taken whose hash is
    below its share, so that no group is gathered or sorted.
    """
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return [], []
    each = min(TRAIN_PER_LANGUAGE, max(1, TRAIN_TEXTS // len(sizes)))
    bound = F.lit(0.0)
    for name, size in sizes.items():
        # A few rows are all taken.
        bound = F.when(F.col("lang") == name, F.lit(each / max(each, size))).otherwise(bound)
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.filter(draw < bound).select("text", "lang", "doc_id")
    found = sample.orderBy("doc_id", "text").limit(2 * TRAIN_TEXTS).collect()
    return [r["text"] for r in found], [r["lang"] for r in found]


def _predictions(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [model.predict(t) for t in batch.column("text").to_pylist()]
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "held_out": batch.column("held_out"),
            "lang_pred": pa.array([x[0] for x in found], pa.string()),
            "score": pa.array([x[1] for x in found], pa.float64()),
            "ambiguous": pa.array([x[2] for x in found], pa.bool_()),
        })


def identify(
    docs: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for each row of ``docs``.

    Rows where ``held_out``, an expression over ``doc_id``, holds are not learned
    from. Only the text is an input of a prediction.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").alias("text"),
        F.col(f"`{lang_column}`").alias("lang"),
    ).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = fit(*training_texts(rows.filter(~F.col("held_out"))))
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        partial(_predictions, model=model),
        "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean",
    )
