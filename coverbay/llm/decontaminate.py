"""Benchmark decontamination with suffix arrays over the training documents.

Each task cuts its documents into shards of about ``SHARD_BYTES``. A shard's words become numbers
(equal 64-bit hashes are equal words), and its suffix array lists all word positions in the order of
the words from there on. All suffixes of the benchmark's items are then binary-searched in it
together. The range of a suffix gives every place where its first 13 words stand; its neighbours
give the longest verbatim match. A document lies in one shard whole, so nothing is shuffled; a task
holds one shard, or one document if that is longer.

Words: A-Z lower-cased, then runs of digits, a-z and anything beyond ASCII. A window is 13
consecutive words of an item; an item of fewer words is one window; an item without words is none.

NULL and empty texts have no words and are clean. NULL items are none, and an item without id goes by
the empty id. Repeated documents count each for themselves; repeated items too (their ids are listed once). Empty tables give empty results, an
empty benchmark a clean corpus. All columns of the documents pass through under their own names; the
new ones get longer names where they would clash.

The benchmark reaches the tasks in blocks of at most ``BLOCK_BYTES`` of text, each with a pass of its
own over the documents that adds to what the passes before it found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from coverbay.llm.shared import fresh
from coverbay.llm.wordhash import portions, word_hashes

WINDOW = 13
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 32 << 20


class Patterns:
    """All suffixes of the items' words, one after another."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.words, first = word_hashes([text for _, text in items])
        lengths = np.diff(first)
        self.items = np.array([item for item, _ in items], object)[lengths > 0]
        lengths = lengths[lengths > 0]
        self.item = np.repeat(np.arange(len(lengths)), lengths)
        ends = np.repeat(np.cumsum(lengths), lengths)
        self.start = np.arange(len(self.words))
        self.left = ends - self.start  # words from here to the item's end
        self.offset = self.start - (ends - np.repeat(lengths, lengths))
        self.window = (self.left >= window) | (self.offset == 0)
        self.depth = np.minimum(self.left, window)
        self.longest = int(lengths.max(initial=0))


class Shard:
    """The suffix array of some documents, in order as far as ``depth`` words."""

    def __init__(self, texts: list[bytes | None], depth: int):
        hashes, first = word_hashes(texts)
        self.n_words = np.diff(first)
        self.begin = first[:-1] + np.arange(len(texts))
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        # a 0 after each document: no pattern has it, so no match reaches into the next document
        self.ids = np.zeros(len(hashes) + len(texts), np.int64)
        self.ids[np.arange(len(hashes)) + np.repeat(np.arange(len(texts)), self.n_words)] = number + 1
        self.order = self._sorted(depth)

    def _sorted(self, depth: int) -> np.ndarray:
        """Prefix doubling from a first sort by two or three words; only ties are sorted again."""
        n, known = len(self.ids), 3 if len(self.vocabulary) < 1 << 21 else 2
        bits = 63 // known
        padded = np.concatenate((self.ids, np.zeros(known, np.int64)))
        key = padded[:n].copy()
        for k in range(1, known):
            key = (key << bits) | padded[k : n + k]
        order = np.argsort(key)
        slots, key = np.arange(n), key[order]
        rank = np.empty(n, np.int64)
        while True:
            first = np.concatenate(([True], key[1:] != key[:-1]))[:n]
            group = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
            rank[order[slots]] = group
            tied = ~(first & np.concatenate((first[1:], [True]))[: len(first)])
            slots = slots[tied]
            if known >= depth or not len(slots):
                return order
            at = order[slots]
            behind = at + known
            key = (rank[at] << 32) | np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
            sort = np.argsort(key)
            order[slots], key = at[sort], key[sort]
            known *= 2

    def compare(self, slots: np.ndarray, pattern: np.ndarray, start: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sign of suffix against pattern, and how many words are equal, as far as ``depth``."""
        sign, equal = np.zeros(len(slots), np.int8), np.zeros(len(slots), np.int64)
        live, at = np.arange(len(slots)), self.order[slots]
        k = 0
        while len(live):
            mine = np.where(at + k < len(self.ids), self.ids[np.minimum(at + k, len(self.ids) - 1)], 0)
            theirs = pattern[start[live] + k]
            sign[live] = np.sign(mine - theirs)
            same = mine == theirs
            k += 1
            equal[live[same]] = k
            more = same & (k < depth[live])
            live, at = live[more], at[more]
        return sign, equal

    def bound(self, pattern: np.ndarray, start: np.ndarray, depth: np.ndarray, after: bool) -> np.ndarray:
        """First slot not before the pattern, or the first one after all that begin with it."""
        low, high = np.zeros(len(start), np.int64), np.full(len(start), len(self.order), np.int64)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            sign, _ = self.compare(middle, pattern, start[open_], depth[open_])
            right = sign <= 0 if after else sign < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    def numbered(self, patterns: Patterns) -> np.ndarray:
        """The patterns' words in this shard's numbers; -1 where the shard lacks the word."""
        at = np.searchsorted(self.vocabulary, patterns.words)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == patterns.words[known]
        return np.where(known, at + 1, -1)

    def windows(self, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
        """(position, pattern) of each place where a window stands."""
        pattern = self.numbered(patterns)
        chosen = np.flatnonzero(patterns.window)
        chosen = chosen[pattern[chosen] >= 0]
        start, depth = patterns.start[chosen], patterns.depth[chosen]
        low = self.bound(pattern, start, depth, after=False)
        here = np.flatnonzero(low < len(self.order))
        sign, _ = self.compare(low[here], pattern, start[here], depth[here])
        here = here[sign == 0]
        chosen, low = chosen[here], low[here]
        places = self.bound(pattern, start[here], depth[here], after=True) - low
        within = np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
        return self.order[np.repeat(low, places) + within], np.repeat(chosen, places)

    def longest(self, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
        """(words matched, position) of the longest verbatim match of each pattern."""
        pattern = self.numbered(patterns)
        slot = self.bound(pattern, patterns.start, patterns.left, after=False)
        best, place = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
        for neighbour in (slot - 1, slot):
            here = np.flatnonzero((neighbour >= 0) & (neighbour < len(self.order)))
            _, equal = self.compare(neighbour[here], pattern, patterns.start[here], patterns.left[here])
            better = equal > best[here]
            best[here[better]] = equal[better]
            place[here[better]] = self.order[neighbour[here[better]]]
        return best, place


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _hits(texts: list[bytes | None], patterns: Patterns, most: int) -> Iterator[tuple[int, list, list]]:
    """(words, spans, item ids) of each text."""
    for _, rows in portions(texts, most):
        shard = Shard(rows, WINDOW)
        place, pattern = shard.windows(patterns)
        edge = np.zeros(len(shard.ids) + 1, np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + patterns.depth[pattern], -1)
        covered = np.concatenate(([False], np.cumsum(edge) > 0))
        turns = np.flatnonzero(covered[1:] != covered[:-1])
        spans, found = [[] for _ in rows], [[] for _ in rows]
        for start, end in zip(turns[::2], turns[1::2]):
            row = int(np.searchsorted(shard.begin, start, "right")) - 1
            spans[row].append((int(start - shard.begin[row]), int(end - shard.begin[row])))
        pairs = np.unique(np.stack((np.searchsorted(shard.begin, place, "right") - 1, patterns.item[pattern])), axis=1)
        for row, item in pairs.T:
            found[row].append(patterns.items[item])
        yield from zip(shard.n_words.tolist(), spans, found)


def _blocks(benchmark: DataFrame, most: int) -> list[list[tuple[str, bytes | None]]]:
    """The items in lists of at most about ``most`` bytes, one list in memory for each broadcast."""
    kept = benchmark.where(F.col("text").isNotNull()).select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    kept = kept.distinct()  # equal rows would all meet in one block
    size = kept.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-2 * size // most))
    if blocks == 1:
        return [[(r[0], r[1].encode()) for r in kept.collect()]]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return ([(r[0], r[1].encode()) for r in kept.where(part == i).collect()] for i in range(blocks))


def annotate(documents: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """The documents with n_words, spans (word ranges hit, disjoint and ascending) and items (ids found).

    Also returns the names that these three columns got, longer ones where the documents have them.
    """
    taken = documents.columns
    names: dict[str, str] = {}
    for name in ("n_words", "spans", "items"):
        names[name] = fresh([*taken, *names.values()], name)
    schema = T.StructType([*documents.schema.fields])
    span = T.StructType().add("start", T.LongType()).add("end", T.LongType())
    schema.add(names["n_words"], T.LongType()).add(names["spans"], T.ArrayType(span))
    schema.add(names["items"], T.ArrayType(T.StringType()))
    context = documents.sparkSession.sparkContext
    out = documents
    for number, block in enumerate(_blocks(benchmark, block_bytes)):
        shared = context.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared, first=number == 0) -> Iterator[pa.RecordBatch]:
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            patterns = Patterns(shared.value, WINDOW)
            for batch in batches:
                texts = batch.column(taken.index("text")).cast(pa.binary()).to_pylist()
                found = list(_hits(texts, patterns, shard_bytes))
                counts, spans, items = ([row[i] for row in found] for i in range(3))
                if not first:
                    before = [[(s["start"], s["end"]) for s in row] for row in batch.column(len(taken) + 1).to_pylist()]
                    spans = [_merged(a + b) for a, b in zip(before, spans)]
                    items = [sorted({*a, *b}) for a, b in zip(batch.column(len(taken) + 2).to_pylist(), items)]
                spans = [[{"start": a, "end": b} for a, b in row] for row in spans]
                new = [pa.array(counts, pa.int64()), pa.array(spans, kind), pa.array([sorted(set(x)) for x in items], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(taken)], *new], names=schema.names)

        out = out.mapInArrow(search, schema)
    return out, names


def hit_words(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def contaminated(n_words: str, spans: str):
    """Some word is hit, and a twentieth of the words at least."""
    return (hit_words(spans) > 0) & (20 * hit_words(spans) >= F.col(n_words))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with their own columns, that are not contaminated."""
    found, names = annotate(documents, benchmark, **options)
    return found.where(~contaminated(names["n_words"], names["spans"])).drop(*names.values())


def longest_matches(documents: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per item with words: the longest verbatim match in any document.

    item_id (text), words, item_offset, doc_id, doc_offset; the least (item_offset, doc_id,
    doc_offset) among equals, and NULLs after 0 words where nothing matches.
    """
    context, parts = documents.sparkSession.sparkContext, []
    spark = documents.sparkSession
    schema = "item_id string, words long, item_offset long, doc_id long, doc_offset long"
    kind = pa.schema([("item_id", pa.string()), *((n, pa.int64()) for n in ("words", "item_offset", "doc_id", "doc_offset"))])
    for block in _blocks(benchmark, block_bytes):
        shared = context.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            patterns = Patterns(shared.value, WINDOW)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                texts = batch.column(1).cast(pa.binary()).to_pylist()
                for first, rows in portions(texts, shard_bytes):
                    shard = Shard(rows, patterns.longest)
                    best, place = shard.longest(patterns)
                    # the best suffix of each item: most words, then the earliest offset
                    sort = np.lexsort((patterns.offset, -best, patterns.item))
                    head = sort[np.unique(patterns.item[sort], return_index=True)[1]] if len(sort) else sort
                    head = head[best[head] > 0]
                    row = np.searchsorted(shard.begin, place[head], "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(list(patterns.items[patterns.item[head]]), pa.string()),
                            pa.array(best[head]),
                            pa.array(patterns.offset[head]),
                            pa.array([ids[first + r] for r in row], pa.int64()),
                            pa.array(place[head] - shard.begin[row]),
                        ],
                        schema=kind,
                    )

        parts.append(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, schema))
        none = [(item, 0, None, None, None) for item in set(Patterns(block, WINDOW).items)]
        if none:
            parts.append(spark.createDataFrame(none, schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("words")).alias("less"), "item_offset", "doc_id", "doc_offset")).alias("best")
    return found.groupBy("item_id").agg(best).select(
        "item_id", (-F.col("best.less")).alias("words"), "best.item_offset", "best.doc_id", "best.doc_offset"
    )
