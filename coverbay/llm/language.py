"""Language identification by interpolated Kneser-Ney character models.

Texts are words of letters, lower-cased; a word is its letters and its end, each predicted from the
``ORDER - 1`` symbols before it in the word. Symbols are 16-bit code points (letters beyond those share
one code), so four of them are one 64-bit number. Of all learning documents, each word's symbols are
counted by language; everything else follows from these counts in Spark: an order-n model interpolates

    p_n(d | context) = (count - D) / count(context) + D types(context) / count(context) p_(n-1)(d | ...)

with raw counts in the highest order and, below it, the number of different symbols that precede. Every
term is kept, by a 64-bit hash that is one to one on grams, so no two grams share a value. Up to
``MOST_TERMS`` terms (12 bytes each) are broadcast as sorted arrays. A larger model stays a table:
documents are cut in runs of about 4 MB, the terms that a run's texts ask for are joined to the table,
and each run meets what was found. Both ways score alike. Any number of languages can be learned; the
driver keeps their names, and texts meet one after the other, so that only the best so far is kept.

The language with the least cross-entropy per symbol is predicted, the first in code-point order among
equals. The score is the softmax of the cross-entropies times ``sharpness`` times the root of the
number of symbols. ``sharpness`` and the rejection threshold, the cross-entropy that ``REJECT`` of the
calibration texts exceed, come from all learning rows whose text's hash falls in a share of one in
``HELD``, judged by a model that counts none of them; then all learning rows make the model that judges
the documents. Equal texts fall on the same side. If no such row has a language that model knows, all
learning rows are judged by the final model. A text whose best cross-entropy is beyond the threshold has
``rejected`` set: no learned language fits it well.

NULL texts and texts without a letter are ``und`` with score 0; so are all texts if nothing could be
learned. Documents without language teach nothing. Repeated rows count each time. Columns pass through;
the new ones get longer names where they would clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from coverbay.llm.features import texts_of
from coverbay.llm.shared import fresh, materialise
from coverbay.llm.wordhash import Runs, portions

ORDER = 4
MOST_TERMS = 1 << 21
HELD = 16
REJECT = 0.001
_RANKS = 100_000  # percentiles are exact to one rank in so many
_SHARPNESS = [0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0]
_SYMBOLS = 1 << 16
_RUN_BYTES = 4 << 20

#: a-z after lower-casing and bytes beyond ASCII
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, word): 0 where no letter is; each word between zeros."""
    points = np.frombuffer(("\n" + "\n".join(w.decode() for w in words) + "\n").lower().encode("utf-32-le"), np.uint32)
    kinds, at = np.unique(points, return_inverse=True)
    code = np.array([min(int(k), _SYMBOLS - 1) if chr(k).isalpha() else 0 for k in kinds], np.uint64)
    line = points == 10
    return code[at], np.cumsum(line) - 1 - line  # the line end after a word is the word's end


class Grams:
    """The grams of the different words of some texts.

    ``gram[i]`` belongs to word ``word[i]``; ``used[j]`` is the different word that the texts' word j is.
    """

    def __init__(self, texts: list[bytes | None]):
        runs = Runs(texts, _LETTERS)
        self.first = runs.first
        _, example, self.used = np.unique(runs.hashes(), return_index=True, return_inverse=True)
        self.words = len(example)
        data = runs.data.tobytes()
        start, end = runs.start[example].tolist(), (runs.start + runs.length)[example].tolist()
        symbol, word = _symbols([data[a:b] for a, b in zip(start, end)])
        before, gram, inside = symbol, symbol.copy(), np.ones(len(symbol), bool)
        for place in range(1, ORDER):
            before = np.concatenate(([np.uint64(0)], before[:-1]))
            inside &= before != 0
            gram |= np.where(inside, before, np.uint64(0)) << np.uint64(16 * place)
            if place == 1:
                predicted = (symbol != 0) | inside
        self.gram, self.word = gram[predicted], word[predicted]


def _counts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    grams = Grams(texts)
    times = np.bincount(grams.used, minlength=grams.words)
    values, at = np.unique(grams.gram, return_inverse=True)
    return values, np.bincount(at, times[grams.word], len(values)).astype(np.int64)


def gram_counts(documents: DataFrame) -> DataFrame:
    """(lang, gram, n) of documents (lang, text) with neither NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), object), texts_of(batch)
            for lang in sorted(set(langs)):
                mine = [texts[i] for i in np.flatnonzero(langs == lang)]
                for _, some in portions(mine):
                    values, n = _counts(some)
                    lang_column = pa.array([lang] * len(n), pa.string())
                    yield pa.RecordBatch.from_arrays([lang_column, pa.array(values.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    found = documents.mapInArrow(run, "lang string, gram long, n long")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _terms(counts: DataFrame, order: int) -> DataFrame:
    """(lang, part, gram, value): discounted shares of the grams, and what the contexts leave over."""
    context = F.shiftrightunsigned("gram", 16)
    seen = counts.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
    estimate = F.try_divide(F.col("once"), F.col("once") + 2 * F.col("twice"))
    discount = F.when(estimate.isNull(), 0.5).otherwise(F.least(F.greatest(estimate, F.lit(0.1)), F.lit(0.95)))
    seen = seen.select("lang", discount.alias("discount"))
    sums = counts.groupBy("lang", context.alias("context")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
    sums = sums.join(F.broadcast(seen), "lang")  # a row per language
    rest = sums.select("lang", F.lit(-order).alias("part"), F.col("context").alias("gram"), (F.col("discount") * F.col("types") / F.col("total")).alias("value"))
    shares = counts.withColumn("context", context).join(sums, ["lang", "context"])
    value = F.greatest((F.col("n") - F.col("discount")) / F.col("total"), F.lit(1e-12))
    return shares.select("lang", F.lit(order).alias("part"), "gram", value.alias("value")).union(rest)


@dataclass(frozen=True)
class Stored:
    """A model too large to broadcast: its languages, and its terms (lang, part, hash, value)."""

    langs: list[str]
    terms: DataFrame


def _arrays(langs: list[str], terms: pa.Table) -> dict[str, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """By language and part: sorted hashes and values."""
    number, part, key, value = (
        x.to_numpy() for x in (pc.index_in(terms["lang"], pa.array(langs, pa.string())), *(terms[n] for n in ("part", "hash", "value")))
    )
    place = number.astype(np.int64) * (2 * ORDER + 1) + part + ORDER
    sort = np.lexsort((key, place))
    place, key, value = place[sort], key[sort], value[sort]
    ends = np.searchsorted(place, np.arange(len(langs) * (2 * ORDER + 1) + 1)).tolist()
    model = {}
    for i, lang in enumerate(langs):
        at = lambda p: slice(*ends[i * (2 * ORDER + 1) + p + ORDER :][:2])  # noqa: B023, E731
        model[lang] = {p: (key[at(p)], value[at(p)]) for p in range(-ORDER, ORDER + 1) if p}
    return model


def learned(documents: DataFrame) -> dict[str, dict[int, tuple[np.ndarray, np.ndarray]]] | Stored:
    """By language and part: sorted hashes and values. Part n: shares of order n; -n: what is left over."""
    return modelled(materialise(gram_counts(documents.where("lang is not null and text is not null").select("lang", "text"))))


def modelled(counts: DataFrame) -> dict[str, dict[int, tuple[np.ndarray, np.ndarray]]] | Stored:
    """The model of counts (lang, gram, n)."""
    parts, level = None, counts
    for order in range(ORDER, 0, -1):
        terms = _terms(level, order)
        parts = terms if parts is None else parts.union(terms)
        below = F.col("gram").bitwiseAND(F.lit((1 << 16 * (order - 1)) - 1))
        level = level.groupBy("lang", below.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    stored = materialise(parts.select("lang", "part", F.xxhash64("gram").alias("hash"), F.col("value").cast("float").alias("value")))
    langs = sorted(r["lang"] for r in stored.select("lang").distinct().collect())
    return Stored(langs, stored) if stored.count() > MOST_TERMS else _arrays(langs, stored.toArrow())


def languages(model: dict | Stored) -> list[str]:
    return model.langs if isinstance(model, Stored) else list(model)


def _xxhash64(value: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of one long: the published algorithm for eight bytes with seed 42.

    Products with odd numbers, turns and shifted XORs can all be undone, so different longs differ in it.
    """
    one, two, three, four, five = (
        np.uint64(p)
        for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )
    turn = lambda x, by: (x << np.uint64(by)) | (x >> np.uint64(64 - by))
    out = (np.uint64(42) + five + np.uint64(8)) ^ (turn(value * two, 31) * one)
    out = turn(out, 27) * one + four
    out = (out ^ (out >> np.uint64(33))) * two
    out = (out ^ (out >> np.uint64(29))) * three
    return out ^ (out >> np.uint64(32))


def _found(part: tuple[np.ndarray, np.ndarray], hashes: np.ndarray, missing: float) -> np.ndarray:
    keys, values = part
    if not len(keys):
        return np.full(len(hashes), missing)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, values[at], missing)


def _asked(gram: np.ndarray) -> dict[int, np.ndarray]:
    """By part: the hashes of the terms that each gram's probability is made of."""
    out = {}
    for order in range(1, ORDER + 1):
        whole = gram & np.uint64((1 << 16 * order) - 1)
        out[order], out[-order] = (_xxhash64(x).view(np.int64) for x in (whole, whole >> np.uint64(16)))
    return out


def log_probabilities(parts: dict, asked: dict[int, np.ndarray]) -> np.ndarray:
    """Natural log of each gram's probability in one language."""
    p = np.full(len(asked[1]), 1 / _SYMBOLS)
    for order in range(1, ORDER + 1):
        p = _found(parts[order], asked[order], 0.0) + _found(parts[-order], asked[-order], 1.0) * p
    return np.log(p)


def _entropies(model: dict, texts: list[bytes | None]) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """(symbols of each text, for one language after the other the cross-entropy of each text)."""
    grams = Grams(texts)
    values, at = np.unique(grams.gram, return_inverse=True)
    asked = _asked(values)
    text = np.repeat(np.arange(len(texts)), np.diff(grams.first))
    word_size = np.bincount(grams.word, minlength=grams.words)
    size = np.bincount(text, word_size[grams.used], len(texts))

    def entropy(parts: dict) -> np.ndarray:
        word = np.bincount(grams.word, log_probabilities(parts, asked)[at], grams.words)
        return -np.bincount(text, word[grams.used], len(texts)) / np.maximum(size, 1)

    return size, map(entropy, model.values())


def cross_entropies(model: dict, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of each text, cross-entropy of each text in each language)."""
    size, columns = _entropies(model, texts)
    return size, np.stack(list(columns), axis=1)


def _compete(size: np.ndarray, columns: Iterator[np.ndarray], sharpness: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best language of each text, its cross-entropy, and the languages' summed weights for each sharpness).

    A language weighs exp(-gap); the best one's gap is 0. The gap is that of the cross-entropies times
    the sharpness times the root of the number of symbols.
    """
    scale = np.array(sharpness)[:, None] * np.sqrt(size)
    best, least, weight = np.zeros(len(size), np.int64), np.full(len(size), np.inf), np.zeros(scale.shape)
    for number, entropy in enumerate(columns):
        better = entropy < least
        fall = np.exp(-np.abs(entropy - least) * scale) if number else np.zeros(scale.shape)
        weight = np.where(better, weight * fall + 1, weight + fall)
        best, least = np.where(better, number, best), np.where(better, entropy, least)
    return best, least, weight


def _in_runs(documents: DataFrame, name: str) -> DataFrame:
    """The documents with the number of their run, about ``_RUN_BYTES`` of texts; kept, as it is read twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            upto = size + np.cumsum([len(text or b"") + 1 for text in texts_of(batch)], dtype=np.int64)
            before = np.concatenate(([size], upto))[: len(upto)]
            size = int(upto[-1]) if len(upto) else size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first + before // _RUN_BYTES)], [*batch.schema.names, name])

    return materialise(documents.mapInArrow(run, T.StructType([*documents.schema.fields]).add(name, T.LongType())))


def _judged(documents: DataFrame, model: dict | Stored, judge: Callable, schema: T.StructType) -> DataFrame:
    """The rows that ``judge(model, batch)`` makes of the documents, its model having all terms they ask for."""
    if not isinstance(model, Stored):
        shared = documents.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield judge(shared.value, batch)

        return documents.mapInArrow(run, schema)
    langs, name = model.langs, fresh(documents.columns, "run")
    rows = _in_runs(documents, name)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = texts_of(batch), batch.column(1).to_numpy()
            for number in np.unique(numbers):
                gram = np.unique(Grams([texts[i] for i in np.flatnonzero(numbers == number)]).gram)
                for part, hashes in _asked(gram).items():
                    hashes = np.unique(hashes)
                    columns = [pa.array(np.full(len(hashes), x, kind)) for x, kind in ((number, np.int64), (part, np.int32))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(hashes)], [name, "part", "hash"])

    def meet(rows: pa.Table, terms: pa.Table) -> pa.Table:
        here = _arrays(langs, terms)  # terms asked for in two batches are there twice, with one value
        return pa.Table.from_batches([judge(here, batch) for batch in rows.drop_columns([name]).combine_chunks().to_batches()])

    # a key meets a row per language here and a row per run there, never a row per document
    terms = rows.select("text", name).mapInArrow(ask, f"`{name}` long, part int, hash long").join(model.terms, ["part", "hash"])
    return rows.groupBy(name).cogroup(terms.groupBy(name)).applyInArrow(meet, schema)


def calibrated(documents: DataFrame, model: dict | Stored) -> tuple[float, float] | None:
    """(sharpness, rejection threshold) of all documents (text, lang) with a language of the model; None without any."""
    if not model:
        return None
    langs = languages(model)
    kept = documents.where("text is not null and lang is not null").select("text", "lang")

    def judge(model: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        truth = pc.index_in(batch.column(1), pa.array(langs, pa.string())).fill_null(-1).to_numpy().astype(np.int64)
        losses, entropies = [], []
        for row, texts in portions(texts_of(batch)):
            true, own = truth[row : row + len(texts)], np.zeros(len(texts))
            size, columns = _entropies(model, texts)

            def noted(columns: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
                for number, entropy in enumerate(columns):
                    own[true == number] = entropy[true == number]  # noqa: B023
                    yield entropy

            _, least, weight = _compete(size, noted(columns), _SHARPNESS)
            scale = np.array(_SHARPNESS)[:, None] * np.sqrt(size)
            loss = np.minimum((own - least) * scale + np.log(weight), -np.log(1e-9)).T
            here = (size > 0) & (true >= 0)
            losses += loss[here].tolist()
            entropies += own[here].tolist()
        return pa.RecordBatch.from_arrays([pa.array(losses, pa.list_(pa.float64())), pa.array(entropies, pa.float64())], ["loss", "entropy"])

    schema = T.StructType().add("loss", T.ArrayType(T.DoubleType())).add("entropy", T.DoubleType())
    losses = _judged(kept, model, judge, schema)
    total = F.array(*(F.sum(F.col("loss")[i]) for i in range(len(_SHARPNESS)))).alias("total")
    row = losses.agg(total, F.percentile_approx("entropy", 1 - REJECT, _RANKS).alias("threshold")).first()
    return None if row["threshold"] is None else (_SHARPNESS[int(np.argmin(row["total"]))], row["threshold"])


def identify(documents: DataFrame, model: dict | Stored, sharpness: float, threshold: float) -> tuple[DataFrame, dict[str, str]]:
    """The documents with lang_pred, score, cross_entropy and rejected, and the names these got."""
    names: dict[str, str] = {}
    for name in ("lang_pred", "score", "cross_entropy", "rejected"):
        names[name] = fresh([*documents.columns, *names.values()], name)
    schema = T.StructType([*documents.schema.fields])
    for name, kind in zip(names.values(), (T.StringType(), T.DoubleType(), T.DoubleType(), T.BooleanType())):
        schema.add(name, kind)
    langs = np.array([*languages(model), "und"], object)

    def judged(model: dict, texts: list[bytes | None]) -> tuple[np.ndarray, ...]:
        if not model:
            nothing = np.zeros(len(texts))
            return np.full(len(texts), -1), nothing, nothing, nothing > 0
        size, columns = _entropies(model, texts)
        best, least, weight = _compete(size, columns, [sharpness])
        none = size == 0
        least = np.where(none, 0.0, least)
        return np.where(none, -1, best), np.where(none, 0.0, 1 / weight[0]), least, least > threshold

    def judge(model: dict, batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [judged(model, texts) for _, texts in portions(texts_of(batch))]
        best, *rest = (np.concatenate(x) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4
        new = [pa.array(list(langs[best]), pa.string()), pa.array(rest[0], pa.float64()), pa.array(rest[1], pa.float64()), pa.array(rest[2].astype(bool))]
        return pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return _judged(documents, model, judge, schema), names


def train(documents: DataFrame, learn: Column) -> tuple[dict | Stored, float, float]:
    """Model, sharpness and threshold from the documents that fulfil ``learn`` and have a language."""
    lessons = documents.where(learn).where("lang is not null and text is not null").select("lang", "text")
    held = F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0
    apart, rest = (materialise(gram_counts(lessons.where(rows))) for rows in (held, ~held))
    model = modelled(rest.union(apart).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    return model, *(calibrated(lessons.where(held), modelled(rest)) or calibrated(lessons, model) or (1.0, 0.0))
