"""Operator 10: SentencePiece encoding and decoding as a relational lattice.

A text becomes words: spaces are written as U+2581, one more is put in front, and a
word begins at each; if the piece table allows it, also between letters and marks. No
piece that can be chosen crosses the beginning of a word, which is checked on the table,
so words are encoded by themselves, each distinct word once:

1. substrings of bounded length are exploded from each word,
2. and joined to the piece table on equality; what matches is an edge of the word's
   lattice, and a character that is no piece is an edge of its own, spelt in bytes;
3. edges are grouped by word, without another shuffle, as the words are already dealt
   by their value;
4. a fold over the edges, ordered by their ends, keeps the best score of each
   position (Viterbi), and a second fold walks back from the end, for many words at
   a time.

The best segmentation is the one with the greatest sum of scores; of equal sums the
one whose last piece is longest, and so on backwards. A character without a piece
scores 10 below the least piece. That is what SentencePiece calls a unigram model.
The public table comes from a merge model, whose own encoder applies merges one by
one, so its ids can differ; decoding is the same.

Defined cases: null and empty texts have no words; rows with one id, or with none, are
encoded one by one; a U+2581 in a text is read as a
space; a word of any length is encoded whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.frames import filesystem, give_back, keep, replacing, slices, texts_of, workspace

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Characters of a word that are cut out at a time, so that long words stay linear.
STRIP = 64
# Letters of Latin-1, and ASCII that is no letter.
_LETTER = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_MARK = r"\x00-\x40\x5b-\x60\x7b-\x7f"
_AT_MARKS = f"(?<=[{_LETTER}])(?=[{_MARK}])|(?<=[{_MARK}])(?=[{_LETTER}])"
#: Bytes of texts whose words are numbered together, or one longer text.
CHUNK_BYTES = 24 << 20
_NUMBERED_BYTES = 8 << 20
_ROWS_READ = 512
#: Bits of a piece's id in an edge's number; the size of a piece has the rest of 32.
_ID_BITS = 20
#: Words whose ids are put together on their way back to their chunks.
_WORDS_PACKED = 200_000
_CROSSES = re.compile(f"[{_LETTER}][{_MARK}]|[{_MARK}][{_LETTER}]")


@dataclass(frozen=True)
class Pieces:
    """The pieces that can be chosen, as rows; the id of byte 0; bounds; and whether
    words end between letters and marks, as no piece has both.

    The table has one row for each entry of the vocabulary at most, which bounds
    what a broadcast of it takes.
    """

    rows: list[tuple[str, int, float]]
    first_byte: int
    longest: int
    unknown: float
    at_marks: bool

    def frame(self, spark: SparkSession) -> DataFrame:
        table = pa.table({
            "piece": pa.array([r[0] for r in self.rows], pa.string()),
            "id": pa.array([r[1] for r in self.rows], pa.int32()),
            "score": pa.array([r[2] for r in self.rows], pa.float64()),
        })
        return spark.createDataFrame(table)


def load_pieces(model_path: str) -> Pieces:
    """Read the vocabulary of a model file, on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    rows, first_byte = [], None
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            first_byte = i if first_byte is None else first_byte
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            # Pieces that run over the beginning of a word are out of the question.
            if SPACE not in piece[1:]:
                rows.append((piece, i, float(model.get_score(i))))
    if first_byte is None:
        raise ValueError("the model has no byte pieces")
    if len(model) >= 1 << _ID_BITS or max(len(r[0]) for r in rows) >= 1 << 32 - _ID_BITS:
        raise ValueError("the model has too many pieces, or too long ones")
    return Pieces(
        rows,
        first_byte,
        longest=max(len(r[0]) for r in rows),
        unknown=min(r[2] for r in rows) - UNKNOWN_PENALTY,
        at_marks=not any(_CROSSES.search(r[0]) for r in rows),
    )


def words_of(text: Column, pieces: Pieces) -> Column:
    """The words of a text; put together and without the first space they are the text."""
    spaced = F.concat(F.lit(SPACE), F.regexp_replace(text, " ", SPACE))
    cut = f"(?={SPACE})"
    if pieces.at_marks:
        cut += f"|{_AT_MARKS}"
    return F.when(F.length(text) > 0, F.split(spaced, cut)).otherwise(
        F.array().cast("array<string>")
    )


def distinct_words(docs: DataFrame, pieces: Pieces, text_column: str = "text") -> DataFrame:
    """``word, n``: every distinct word and how often it occurs."""
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    words = docs.select(F.explode(words_of(text, pieces)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def edges(words: DataFrame, pieces: Pieces) -> DataFrame:
    """The lattice of each word: ``start, end, id, score`` beside the word's columns.

    Positions count characters; ``id`` is -1 for a character that is no piece.
    """
    spark = words.sparkSession
    last = F.greatest(F.floor((F.length("word") - 1) / STRIP), F.lit(0)).cast("int")
    strips = words.withColumn("strip", F.explode(F.sequence(F.lit(0), last))).withColumn(
        "part", F.expr(f"substring(word, strip * {STRIP} + 1, {STRIP + pieces.longest})")
    )
    starts = strips.withColumn(
        "at", F.explode(F.expr(f"sequence(0, least({STRIP}, length(part)) - 1)"))
    )
    spans = starts.withColumn(
        "size", F.explode(F.expr(f"sequence(1, least({pieces.longest}, length(part) - at))"))
    ).withColumn("piece", F.expr("substring(part, at + 1, size)"))
    met = spans.join(F.broadcast(pieces.frame(spark)), "piece", "left").filter(
        "id IS NOT NULL OR size = 1"
    )
    return met.select(
        *words.columns,
        F.expr(f"strip * {STRIP} + at").alias("start"),
        F.expr(f"strip * {STRIP} + at + size").alias("end"),
        F.coalesce("id", F.lit(-1)).alias("id"),
        F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
    )


def _best_edges(start, end, score, word, lengths) -> tuple[np.ndarray, np.ndarray]:
    """The edges of the best cut of each word, and their words, in the order of the text.

    Edges are ordered by word, end and start. The fold takes one end of all words at a
    time, and so does the walk back with one edge of each word.
    """
    base = np.cumsum(lengths + 1) - (lengths + 1)
    best = np.zeros(int((lengths + 1).sum()))
    came = np.zeros(len(best), np.int64)
    by_end = np.argsort(end, kind="stable")
    cuts = np.flatnonzero(np.diff(end[by_end], prepend=0, append=-1))
    for at, to in pairwise(cuts.tolist()):
        own = by_end[at:to]
        words = word[own]
        sums = best[base[words] + start[own]] + score[own]
        first = np.flatnonzero(np.diff(words, prepend=-1))
        most = np.maximum.reduceat(sums, first)
        group = np.cumsum(np.diff(words, prepend=-1) != 0) - 1
        # Of equal sums the first, which starts first.
        top = np.flatnonzero(sums == most[group])
        top = top[np.diff(group[top], prepend=-1) != 0]
        place = base[words[first]] + end[own[0]]
        best[place] = most
        came[place] = own[top]
    walked, place = [], lengths.copy()
    left = np.arange(len(lengths))
    while len(left):
        edge = came[base[left] + place[left]]
        walked.append(edge)
        place[left] = start[edge]
        left = left[place[left] > 0]
    chosen = np.sort(np.concatenate(walked))
    return chosen, word[chosen]


def encode_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """Add ``ids`` to distinct words (``word`` and any columns that follow from it)."""
    others = [c for c in words.columns if c != "word"]
    # A number sorts quicker than a struct. The end comes first: edges are folded in the
    # order of their ends, then starts, of which the longest piece has the first.
    edge = F.expr(
        f"shiftleft(CAST(end AS bigint), 32) | shiftleft(CAST({pieces.longest} - (end - start)"
        f" AS bigint), {_ID_BITS}) | CAST(id + 1 AS bigint)"
    )
    score_of = {i: score for _, i, score in pieces.rows} | {-1: pieces.unknown}
    scores = np.array([score_of.get(i, 0.0) for i in range(-1, max(score_of) + 1)])
    longest, first_byte = pieces.longest, pieces.first_byte

    @F.arrow_udf("array<int>")
    def best_ids(edges: pa.Array, words: pa.Array) -> pa.Array:
        packed = edges.flatten().to_numpy(zero_copy_only=False)
        n_edges = pc.list_value_length(edges).to_numpy(zero_copy_only=False).astype(np.int64)
        word = np.repeat(np.arange(len(n_edges)), n_edges)
        end = packed >> 32
        start = end - longest + ((packed >> _ID_BITS) & ((1 << 32 - _ID_BITS) - 1))
        known = packed & ((1 << _ID_BITS) - 1)
        # Each character is an edge, so the last edge ends with the word.
        lengths = end[np.cumsum(n_edges) - 1]
        chosen, word_of = _best_edges(start, end, scores[known], word, lengths)
        ids = (known[chosen] - 1).astype(np.int32)
        # What is no piece is spelt in bytes.
        spelt = {}
        last, text = -1, ""
        for k in np.flatnonzero(ids < 0).tolist():
            if word_of[k] != last:
                last, text = word_of[k], words[int(word_of[k])].as_py()
            spelt[k] = text[start[chosen[k]]].encode("utf-8")
        sizes = np.ones(len(ids), np.int64)
        sizes[list(spelt)] = [len(x) for x in spelt.values()]
        ends = np.cumsum(sizes)
        out = np.repeat(ids, sizes)
        for k, x in spelt.items():
            out[ends[k] - len(x) : ends[k]] = [first_byte + b for b in x]
        per_word = np.bincount(word_of, weights=sizes, minlength=len(n_edges)).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_word)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(out))

    # One edge of a word carries its other columns.
    first = (F.col("start") == 0) & (F.col("end") == 1)
    grouped = (
        edges(words, pieces)
        .select("word", edge.alias("edge"), *[F.when(first, F.col(c)).alias(c) for c in others])
        .groupBy("word")
        .agg(
            F.collect_list("edge").alias("edges"),
            *[F.first(c, ignorenulls=True).alias(c) for c in others],
        )
    )
    return grouped.select(
        "word", *others, best_ids(F.sort_array("edges"), F.col("word")).alias("ids")
    )


def decode_ids(
    rows: DataFrame, pieces: Pieces, key: str | None = None, ids: str = "ids"
) -> DataFrame:
    """Add ``text``, what the ids of each row stand for.

    Pieces and single bytes are put together as bytes and read as UTF-8. The space
    that stands before the first word stays. Each row is decoded where it lies, so no
    ``key`` is needed and the work is linear in the ids of a row.
    """
    spelt = {i: piece.encode("utf-8").hex() for piece, i, _ in pieces.rows}
    spelt |= {pieces.first_byte + b: f"{b:02x}" for b in range(256)}
    table = ",".join(spelt.get(i, "") for i in range(max(spelt) + 1))
    # One constant for all rows; an id out of the table spells nothing.
    entries = F.split(F.lit(table), ",", -1)
    parts = F.transform(ids, lambda i: F.coalesce(F.get(entries, i), F.lit("")))
    text = F.decode(F.unhex(F.concat_ws("", parts)), "UTF-8")
    return rows.withColumn("text", F.regexp_replace(text, SPACE, " "))


def _numbered(texts: list[str], number: dict[str, int], cut: re.Pattern | None) -> pa.ListArray:
    """Each text as the numbers of its words; new words get the next ones."""
    column = pa.array([x.replace(SPACE, " ") or None for x in texts], pa.string())
    split = pc.split_pattern(column, " ")
    spaced = split.flatten().dictionary_encode()
    parts: list[int] = []
    ends = [0]
    # Between spaces is a word or, cut at marks, several; only the first has the space.
    for x in spaced.dictionary.to_pylist():
        for word in [SPACE + x] if cut is None or x.isalpha() else cut.split(SPACE + x):
            parts.append(number.setdefault(word, len(number)))
        ends.append(len(parts))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(parts, pa.int32()))
    taken = lists.take(spaced.indices)
    counts = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False)
    lengths = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy())])
    offsets = lengths[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), taken.flatten())


def _frequent_first(
    words: list[str], numbers: list[pa.ListArray]
) -> tuple[list[str], list[pa.ListArray]]:
    """Words and numbers anew, so that frequent words have small numbers, which take less room."""
    n = sum(np.bincount(x.values.to_numpy(), minlength=len(words)) for x in numbers)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    ranked = [pa.ListArray.from_arrays(x.offsets, rank[x.values.to_numpy()]) for x in numbers]
    return [words[i] for i in order], ranked


def _number_words(
    batches: Iterator[pa.RecordBatch], folder: str, at_marks: bool
) -> Iterator[pa.RecordBatch]:
    """Write texts as numbers of their words, a chunk to a file; send the words of each chunk."""
    cut = re.compile(_AT_MARKS) if at_marks else None
    number: dict[str, int] = {}
    doc_ids: list[pa.Array] = []
    numbers: list[pa.ListArray] = []
    held: list[str] = []
    size = held_size = 0

    def flush() -> pa.RecordBatch:
        words, ranked = _frequent_first(list(number), numbers)
        # Of this attempt alone; a file is found by the words that were sent with it.
        chunk = uuid.uuid4().int >> 65
        with replacing(f"{folder}/{chunk}.parquet") as out:
            pq.write_table(
                pa.table({"doc_id": pa.chunked_array(doc_ids), "words": pa.chunked_array(ranked)}),
                out,
                compression="zstd",
                use_dictionary=False,
                column_encoding={"words.list.element": "BYTE_STREAM_SPLIT"},
                row_group_size=_ROWS_READ,
            )
        # A chunk of empty texts is found by a word that it does not use.
        sent = pa.array(words or [SPACE], pa.string())
        # Words in order take less room, here and in the shuffle.
        order = pc.array_sort_indices(sent)
        return pa.record_batch({
            "chunk": pa.array(np.full(len(sent), chunk, np.int64)),
            "at": order.cast(pa.int32()),
            "word": sent.take(order),
        })

    for part in slices(batches, _ROWS_READ):
        doc_ids.append(part.column("doc_id"))
        held += texts_of(part.column("text"))
        held_size += part.column("text").nbytes
        if held_size >= _NUMBERED_BYTES:
            numbers.append(_numbered(held, number, cut))
            size += held_size
            held.clear()
            held_size = 0
        if size >= CHUNK_BYTES:
            yield flush()
            number.clear(), doc_ids.clear(), numbers.clear()
            size = 0
    if doc_ids:
        if held:
            numbers.append(_numbered(held, number, cut))
            held.clear()
        yield flush()
        number.clear(), doc_ids.clear(), numbers.clear()
    give_back()


_PACKED = "chunk long, at binary, sizes binary, ids binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of many words of a chunk in one row, which takes less room on its way."""

    def packed(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks().sort_by([("chunk", "ascending"), ("at", "ascending")])
        chunk, at = (rows.column(c).to_numpy() for c in ("chunk", "at"))
        lists = rows.column("ids").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy().astype("<i4")
        ids = lists.flatten().to_numpy().astype("<i4")
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        spans = list(pairwise(cuts))
        return pa.record_batch({
            "chunk": pa.array([int(chunk[b]) for b, _ in spans], pa.int64()),
            "at": pa.array([_planes(np.diff(at[b:e], prepend=0)) for b, e in spans], pa.binary()),
            "sizes": pa.array([_planes(sizes[b:e]) for b, e in spans], pa.binary()),
            "ids": pa.array([_planes(ids[ends[b] : ends[e]]) for b, e in spans], pa.binary()),
        })

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= _WORDS_PACKED:
            yield packed(pa.Table.from_batches(held))
            held = []
    if held:
        yield packed(pa.Table.from_batches(held))
        held = []
    give_back()


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers, all first bytes first, as high bytes are mostly zero."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<i4")[:, 0]


def _gather(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """The ids of the texts of each chunk; rows of a chunk come one after another."""
    held: list[dict] = []

    def texts() -> Iterator[pa.RecordBatch]:
        at = np.concatenate([np.cumsum(_unplaned(r["at"])) for r in held])
        sizes, ids = (np.concatenate([_unplaned(r[c]) for r in held]) for c in ("sizes", "ids"))
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        own = pa.LargeListArray.from_arrays(ends, ids).take(pa.array(np.argsort(at)))
        fs, name = filesystem(f"{folder}/{held[0]['chunk']}.parquet")
        with fs.open_input_file(name) as source:
            for part in pq.ParquetFile(source).iter_batches(batch_size=_ROWS_READ):
                words = part.column("words")
                found = own.take(words.flatten())
                steps = np.concatenate([[0], np.cumsum(pc.list_value_length(found).to_numpy())])
                bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
                lists = pa.ListArray.from_arrays(
                    pa.array(steps[bounds].astype(np.int32)), found.flatten()
                )
                yield pa.record_batch({"doc_id": part.column("doc_id"), "ids": lists})

    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["chunk"] != row["chunk"]:
                yield from texts()
                held.clear()
            held.append(row)
    if held:
        yield from texts()
        held.clear()
    give_back()


def encode_documents(
    docs: DataFrame,
    pieces: Pieces,
    id_column: str = "doc_id",
    text_column: str = "text",
    work: str | None = None,
) -> DataFrame:
    """``doc_id, ids`` of each row; ids may repeat or be null, each row stays its own.

    Texts do not travel: a chunk of them is written once as numbers of its distinct words,
    these are dealt by word, each is encoded once for all chunks, and its ids go
    back to the chunks that have it, which put their texts together.
    """
    folder = f"{workspace(docs.sparkSession, work)}/lattice-{uuid.uuid4().hex[:8]}"
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    sent = keep(
        rows.mapInArrow(
            partial(_number_words, folder=folder, at_marks=pieces.at_marks),
            "chunk long, at int, word string",
        ),
        folder,
        "words",
    )
    # Dealt as they are: chunks have a word once, so lists before the shuffle save nothing.
    dealt = sent.repartition("word")
    words = dealt.groupBy("word").agg(F.collect_list(F.struct("chunk", "at")).alias("places"))
    found = encode_words(words, pieces).select(F.explode("places").alias("place"), "ids")
    back = found.select("place.chunk", "place.at", "ids").mapInArrow(_pack, _PACKED)
    # One row for each chunk of texts, so their number is small.
    n = max(1, sent.filter("at = 0").count())
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (
        back.repartition(n, "chunk")
        .sortWithinPartitions("chunk")
        .mapInArrow(partial(_gather, folder=folder), f"doc_id {kind}, ids array<int>")
    )
