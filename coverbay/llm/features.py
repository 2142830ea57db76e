"""Hashed terms of texts, and how the two classifiers over them are trained and applied in Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from coverbay.llm.shared import fresh
from coverbay.llm.wordhash import Runs, hashed_runs, mixed, portions

_ALL = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x20 or b == 0x7F else b for b in range(256))
#: 0: space, 1: digits, letters and bytes beyond ASCII, 2: punctuation
_KIND = np.array([0 if b <= 0x20 or b == 0x7F else 1 if chr(b).isalnum() or b >= 0x80 else 2 for b in range(256)], np.uint8)
_SAME = np.uint64(0x5A17)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Tokens:
    """Lower-cased words and runs of punctuation, in order, by text."""

    def __init__(self, texts: list[bytes | None]):
        ends = np.cumsum([len(text) + 1 if text else 1 for text in texts])
        joined = b"\n".join(text or b"" for text in texts)
        data = np.frombuffer(b" " + joined.translate(_ALL) + b" " * 16, np.uint8)
        kind = _KIND[data]
        turns = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        start, length = turns[:-1], np.diff(turns)
        token = kind[start] > 0
        start, length = start[token], length[token]
        self.first = np.concatenate(([0], np.searchsorted(start, ends + 1)))
        self.hashes = hashed_runs(data, start, length)


def _counted(text: np.ndarray, bucket: np.ndarray, bits: int, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each text and the end, buckets, counts): a row per text and bucket."""
    key = np.sort((text.astype(np.uint64) << np.uint64(bits)) | bucket)
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(key)])
    count = np.diff(np.concatenate((head, [len(key)])))
    key = key[head]
    first = np.searchsorted(key, np.arange(texts + 1, dtype=np.uint64) << np.uint64(bits))
    return first, (key & np.uint64((1 << bits) - 1)).astype(np.int64), count


def word_pairs(texts: list[bytes | None], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words and pairs of neighbours, weighing the root of their share of the text's.

    A token that repeats the one before it counts as "same", so that stutter looks alike in any word.
    """
    tokens = Tokens(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(tokens.first))
    hashes, down = tokens.hashes, np.uint64(64 - bits)
    follows = text[1:] == text[:-1]
    single = hashes.copy()
    single[1:][follows & (hashes[1:] == hashes[:-1])] = _SAME
    pair = mixed(single[:-1] * _FACTOR + single[1:])[follows]
    buckets = np.concatenate((mixed(single) >> down, pair >> down))
    first, bucket, count = _counted(np.concatenate((text, text[1:][follows])), buckets, bits, len(texts))
    per_text = np.add.reduceat(np.concatenate((count, [0])), first[:-1]) if len(texts) else first[:-1]
    total = np.repeat(per_text, np.diff(first))
    return first, bucket, np.sqrt(count / np.maximum(total, 1)).astype(np.float32)


def words_and_stems(texts: list[bytes | None], bits: int, full: float, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words and their first 4 to 7 bytes, weighing their share of the text's words.

    A share of ``full`` weighs 1; no weight is above ``most``.
    """
    runs = Runs(texts)
    words = np.diff(runs.first)
    text = np.repeat(np.arange(len(texts)), words)
    down, rows, terms = np.uint64(64 - bits), [text], [runs.hashes() >> np.uint64(64 - bits)]
    for size in range(4, 8):
        longer = runs.length >= size
        stem = hashed_runs(runs.data, runs.start[longer], np.full(longer.sum(), size), seed=size << 32)
        rows.append(text[longer])
        terms.append(stem >> down)
    first, bucket, count = _counted(np.concatenate(rows), np.concatenate(terms), bits, len(texts))
    share = count / np.maximum(np.repeat(words, np.diff(first)), 1)
    return first, bucket, np.minimum(share / full, most).astype(np.float32)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.names.index(name)).cast(pa.binary()).to_pylist()


class Examples:
    """Terms and targets of labelled texts, in the portions they came in; never copied into one."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.target = np.zeros(0, np.int64)

    def add(self, first: np.ndarray, bucket: np.ndarray, weight: np.ndarray) -> None:
        self.parts.append((first, bucket.astype(np.uint32), weight.astype(np.float32)))

    def rows(self) -> np.ndarray:
        """(part, row) of each text."""
        return np.array([(p, row) for p, (first, _, _) in enumerate(self.parts) for row in range(len(first) - 1)]).reshape(-1, 2)

    def row(self, part: int, row: int) -> tuple[np.ndarray, np.ndarray]:
        first, bucket, weight = self.parts[part]
        mine = slice(first[row], first[row + 1])
        return bucket[mine].astype(np.int64), weight[mine]


def fitted(examples: DataFrame, terms: Callable, fit: Callable) -> bytes | None:
    """What ``fit`` makes of the ``Examples`` of the rows (tie, text, target).

    One task reads the rows, a bounded sample, in the order of ``tie`` and keeps their terms, about
    twice the size of their texts for each kind of term.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, targets = Examples(), []
        for batch in batches:
            targets += batch.column(batch.schema.names.index("target")).to_pylist()
            for _, texts in portions(texts_of(batch)):
                kept.add(*terms(texts))
        kept.target = np.array(targets, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([fit(kept)], pa.binary())], ["model"])

    sample = examples.repartition(1).sortWithinPartitions("tie", "text")
    row = sample.mapInArrow(train, "model binary").first()
    return bytes(row["model"]) if row else None


def scored(documents: DataFrame, terms: Callable, score: Callable, model: bytes | None) -> tuple[DataFrame, str]:
    """The documents with a column of scores, and that column's name.

    ``score`` takes the model and (first, bucket, weight) and gives a number between 0 and 1 for each
    text. The model's size is fixed by its number of buckets, so it is broadcast.
    """
    name = fresh(documents.columns, "score")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = score(shared.value)
        for batch in batches:
            found = [apply(*terms(texts)) for _, texts in portions(texts_of(batch))]
            column = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields]).add(name, T.DoubleType())), name
