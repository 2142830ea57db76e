"""Exact BM25 top-k search over sharded inverted indexes with block-max pruning.

Each task indexes its documents in shards of about ``SHARD_BYTES``: postings by term, cut into blocks of
``BLOCK`` documents, with the largest impact of each term in each block. A query first adds up, for
every block, the largest impacts of its terms: no document of the block can score more. Blocks whose
bound lies below the query's bar are skipped. This is the pivot test of block-max WAND, made for all blocks
of a shard at once. Documents are numbered by their most frequent word and length first, so that
blocks hold alike ones and their bounds are tight.

A bar is the k-th best row that is known already. Documents are searched in rounds, chosen by a hash of
the row, each ``GROWTH`` times as large as all before it; the k-th best row of the rounds before is the
bar of the next, for all tasks. A task keeps one list of the best k over its shards. So about
``GROWTH`` * k rows of a query reach the merge of a round, however many shards there are. Equal scores are
told apart by id, so copies pass no bar twice. The first round has no bar; there the ``FIRST_BLOCKS``
blocks of the highest bounds are scored first and give one.

Where bars are known, many queries are searched at once. Most postings belong to few frequent terms, so
their impacts are kept as a matrix too, documents by terms. A block's bound is then the sum of the
largest impacts of the frequent terms in it, by one matrix product, and the best sum of the rare terms in
any of its documents, whose short lists are read whole. In the blocks that are not skipped another
product adds the frequent terms by document, and the documents that reach the bar are scored exactly from
their own postings.

Statistics are global: the number of documents, their mean length and the terms' document frequencies
are counted over all rows before any search, so scores from all shards compare, and the best k of the
shards' best k are the best k of all. A document's score adds its terms in the order of their hashes,
whatever the shard, so it is the same to the last bit.

    score = sum over the query's different words of idf * tf (K1 + 1) / (tf + K1 (1 - B + B words / mean))
    idf = ln(1 + (documents - df + 0.5) / (df + 0.5))

Words: A-Z lower-cased, then runs of digits, a-z and anything beyond ASCII; equal 64-bit hashes are
equal words. Queries reach the tasks in blocks of at most ``QUERY_BYTES``; ``PASS_BLOCKS`` of them share a
pass over the documents and the index of each shard. Ties are broken by the smaller id, rows without id last. Only documents that share a
word with the query are found. NULL and empty texts are found by nothing and find nothing; queries
without an id are ignored. Repeated rows are found each for itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from coverbay.llm.features import texts_of
from coverbay.llm.shared import materialise
from coverbay.llm.wordhash import portions, word_hashes

K1, B = 1.2, 0.75
BLOCK = 32
SHARD_BYTES = 32 << 20
QUERY_BYTES = 32 << 20
PASS_BLOCKS = 4  # blocks of queries for which a shard's index is built once
FREQUENT, MOST_FREQUENT = 40, 1024  # terms of more than one in so many documents are frequent, so many at most
TOGETHER, FEW = 512, 16  # queries whose matrix products, and whose rare terms, are made at once, at most
CELLS = 12 << 20  # of a matrix over a shard's documents, at most
POSTINGS = 1 << 20  # of rare terms read at once, at most, or those of one query
SLACK = 2e-4  # above the rounding of sums of MOST_FREQUENT products in single precision
FIRST_BLOCKS = 8  # blocks scored first where no bar is known
GROWTH = 8
FIRST_TASKS = 4
WORD_SIZE = 6  # bytes of a word and what follows it, for the sizes of rounds only
_NO_ID = np.iinfo(np.int64).max


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after another."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where the rows of sorted columns change."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(columns[0]), bool)
    change[0] = True
    for column in columns:
        change[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(change)


def _postings(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, count) by text and word, and the number of words of each text."""
    hashes, first = word_hashes(texts)
    length = np.diff(first)
    terms, number = np.unique(hashes, return_inverse=True)
    key = np.sort(np.repeat(np.arange(len(texts)), length) * np.int64(len(terms)) + number)
    head = _heads(key)
    text, number = np.divmod(key[head], max(1, len(terms)))
    return text.astype(np.int32), terms[number], np.diff(np.append(head, len(key))).astype(np.int32), length


class Queries:
    """A block of queries: their ids, and the words of each as numbers of the block's vocabulary, ascending."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, number: np.ndarray, terms: np.ndarray, idf: np.ndarray):
        self.ids, self.first, self.number, self.terms, self.idf = ids, first, number, terms, idf

    def words(self, query: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, idf) of a query's words."""
        mine = self.number[self.first[query] : self.first[query + 1]]
        return self.terms[mine], self.idf[mine]

    def places(self, terms: np.ndarray) -> np.ndarray:
        """The place of each word of the vocabulary among ``terms``; -1 for those that aren't."""
        at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
        at[terms[at] != self.terms] = -1
        return at

    def within(self, places: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query - low, place, idf) of the words that have a place, of the queries from ``low`` to ``high``."""
        number = self.number[self.first[low] : self.first[high]]
        query, at = np.repeat(np.arange(high - low), np.diff(self.first[low : high + 1])), places[number]
        here = at >= 0
        return query[here], at[here], self.idf[number[here]]


class Shard:
    """Postings of some documents, by term and block."""

    def __init__(self, ids: np.ndarray, texts: list[bytes | None], mean: float):
        parts, length = [], np.zeros(len(texts), np.int64)
        for row, some in portions(texts):  # words become postings a few MB at a time
            text, hashes, tf, words = _postings(some)
            length[row : row + len(some)] = words
            parts.append((text + row, hashes, tf))
        text, hashes, tf = (np.concatenate(column) for column in zip(*parts))
        del parts
        self.terms, number = np.unique(hashes, return_inverse=True)
        del hashes
        order = self._alike(text, number, tf, length)
        self.ids = ids[order]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sort = np.argsort(number * len(ids) + place[text])
        number, tf, norm = number[sort].astype(np.int32), tf[sort], length[text[sort]] / mean
        self.doc = place[text[sort]].astype(np.int32)
        del text, sort
        self.impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * norm))
        del tf, norm
        entry = _heads(number, self.doc // BLOCK)
        self.entry = np.append(entry, len(number))  # postings of each term and block
        self.term_entry = np.searchsorted(number[entry], np.arange(len(self.terms) + 1))
        self.blocks = -(-len(ids) // BLOCK)
        self._by_document(number)
        self._frequent()

    @cached_property
    def entry_block(self) -> np.ndarray:
        return self.doc[self.entry[:-1]] // BLOCK

    @cached_property
    def entry_most(self) -> np.ndarray:
        return np.maximum.reduceat(self.impact, self.entry[:-1]) if len(self.impact) else np.zeros(0)

    def _by_document(self, number: np.ndarray) -> None:
        """The postings once more, by document and term."""
        narrow = np.uint16 if len(self.ids) <= 1 << 16 else np.int32  # two bytes sort faster
        sort = np.argsort(self.doc.astype(narrow), kind="stable")
        self.row_number, self.row_impact = number[sort], self.impact[sort]
        self.row_first = np.append(0, np.cumsum(np.bincount(self.doc, minlength=len(self.ids))))

    def _frequent(self) -> None:
        """Impacts of the frequent terms as a matrix, documents by terms, and their maxima by block."""
        df = self.entry[self.term_entry[1:]] - self.entry[self.term_entry[:-1]]
        terms = np.flatnonzero(df * FREQUENT > len(self.ids))
        terms = terms[np.argsort(-df[terms], kind="stable")[: min(MOST_FREQUENT, CELLS // len(self.ids))]]
        self.column = np.full(len(self.terms), -1, np.int32)
        self.column[terms] = np.arange(len(terms))
        self.matrix = np.zeros((self.blocks * BLOCK, len(terms)), np.float32)
        for column, term in enumerate(terms.tolist()):
            some = slice(self.entry[self.term_entry[term]], self.entry[self.term_entry[term + 1]])
            self.matrix[self.doc[some], column] = self.impact[some]
        self.most = self.matrix.reshape(self.blocks, BLOCK, len(terms)).max(1)

    @staticmethod
    def _alike(text: np.ndarray, number: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The documents by their most frequent word and length."""
        often = np.lexsort((-tf, text))
        head = often[_heads(text[often])]
        word = np.full(len(length), -1)
        word[text[head]] = number[head]
        return np.lexsort((length, word))

    def best(self, terms: np.ndarray, idf: np.ndarray, k: int, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the query's k best documents, ties at the k-th score included.

        ``terms`` are hashes, ascending; documents that score below ``least`` may be left out.
        """
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        here = self.terms[at] == terms
        at, idf = at[here], idf[here]
        size = self.term_entry[at + 1] - self.term_entry[at]
        entries, weight = _ranges(self.term_entry[at], size), np.repeat(idf, size)
        block = self.entry_block[entries]
        bound = np.bincount(block, weight * self.entry_most[entries], self.blocks) * (1 + 1e-9)
        score = np.zeros(len(self.ids))
        if least <= 0.0 and self.blocks > FIRST_BLOCKS:
            first = np.zeros(self.blocks, bool)
            first[np.argpartition(-bound, FIRST_BLOCKS)[:FIRST_BLOCKS]] = True
            score = self._scores(at, idf, entries, weight, first[block])
            least = _kth(score, k)
        kept = (bound >= least)[block]
        if kept.any():
            score = self._scores(at, idf, entries, weight, kept)
        found = np.flatnonzero((score >= max(least, _kth(score, k))) & (score > 0))
        return found, score[found]

    def passing(self, queries: Queries, bar: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, rows, scores) of all documents that score at least their query's bar, which is above 0.

        Blocks are skipped by their bounds for many queries at once. Sums are in single precision and
        so compared with some ``SLACK``; what reaches the bar with it is then scored as ``best`` does,
        to the last bit.
        """
        places, weights = queries.places(self.terms), np.zeros(len(self.terms))
        together = max(1, min(TOGETHER, CELLS // (self.blocks * BLOCK)))
        for low in range(0, len(bar), together):
            mine = bar[low : low + together]
            query, at, idf = queries.within(places, low, low + len(mine))
            first = np.searchsorted(query, np.arange(len(mine) + 1))
            row, doc = self._likely(query, at, idf, mine * (1 - SLACK))
            heads = _heads(row)
            for start, end in zip(heads.tolist(), [*heads[1:].tolist(), len(row)]):
                number = int(row[start])
                words = slice(first[number], first[number + 1])
                weights[at[words]] = idf[words]
                for cut in range(start, end, 4096):
                    rows = doc[cut : min(end, cut + 4096)]
                    exact = self._exact(rows, weights)
                    good = exact >= mine[number]
                    if good.any():
                        yield low + number, rows[good], exact[good]
                weights[at[words]] = 0.0

    def _likely(self, query: np.ndarray, at: np.ndarray, idf: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row), by query, of the documents whose sum reaches ``least``, from (query, term, idf) of the words."""
        column = self.column[at]
        often = column >= 0
        matrix = np.zeros((len(least), self.matrix.shape[1]), np.float32)
        matrix[query[often], column[often]] = idf[often]
        query, at, idf = query[~often], at[~often], idf[~often]
        first = np.searchsorted(query, np.arange(len(least) + 1))
        read = np.append(0, np.cumsum(self.entry[self.term_entry[at + 1]] - self.entry[self.term_entry[at]]))[first]
        score = np.zeros((len(least), self.blocks * BLOCK), np.float32)
        low = 0
        while low < len(least):
            high = max(low + 1, min(len(least), low + FEW, int(np.searchsorted(read, read[low] + POSTINGS, "right")) - 1))
            some = slice(first[low], first[high])
            score[low:high] = self._rare(query[some] - low, at[some], idf[some], high - low)
            low = high
        bound = matrix @ self.most.T + score.reshape(len(least), self.blocks, BLOCK).max(2)
        kept = bound >= least[:, None]
        pairs = [self._reaching(block, matrix, score, kept, least) for block in np.flatnonzero(kept.any(0)).tolist()]
        if not pairs:
            return (np.zeros(0, np.int32),) * 2
        row, doc = (np.concatenate(column) for column in zip(*pairs))
        sort = np.argsort(row, kind="stable")
        return row[sort], doc[sort]

    def _rare(self, query: np.ndarray, at: np.ndarray, idf: np.ndarray, queries: int) -> np.ndarray:
        """Scores of all documents by these rare terms of some queries."""
        start = self.entry[self.term_entry[at]]
        count = self.entry[self.term_entry[at + 1]] - start
        postings = _ranges(start, count)
        place = np.repeat(query * (self.blocks * BLOCK), count) + self.doc[postings]
        return np.bincount(place, np.repeat(idf, count) * self.impact[postings], queries * self.blocks * BLOCK).reshape(queries, -1)

    def _reaching(self, block: int, matrix: np.ndarray, score: np.ndarray, kept: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of the block's documents that may reach ``least``, for the queries that keep the block."""
        query = np.flatnonzero(kept[:, block])
        rows = slice(block * BLOCK, (block + 1) * BLOCK)
        total = matrix[query] @ self.matrix[rows].T
        total += score[query, rows]
        hit, row = np.nonzero(total >= least[query, None])
        return query[hit].astype(np.int32), (row + block * BLOCK).astype(np.int32)

    def _exact(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of the rows for a query with these weights of all terms, added in the order of the terms."""
        length = self.row_first[rows + 1] - self.row_first[rows]
        postings = _ranges(self.row_first[rows], length)
        return np.bincount(np.repeat(np.arange(len(rows)), length), weights[self.row_number[postings]] * self.row_impact[postings], len(rows))

    def _scores(self, at: np.ndarray, idf: np.ndarray, entries: np.ndarray, weight: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """Scores of the documents in the blocks of the kept entries; where most are kept, of all.

        Whole lists are copied faster than many parts of them. Either way terms are added in one order.
        """
        if np.count_nonzero(kept) * 2 > len(kept):
            start, end = self.entry[self.term_entry[at]], self.entry[self.term_entry[at + 1]]
            spans = [slice(*span) for span in zip(start.tolist(), end.tolist())]
            doc, impact = (np.concatenate([column[span] for span in spans]) for column in (self.doc, self.impact))
            return np.bincount(doc, np.repeat(idf, end - start) * impact, len(self.ids))
        mine = entries[kept]
        count = self.entry[mine + 1] - self.entry[mine]
        postings = _ranges(self.entry[mine], count)
        return np.bincount(self.doc[postings], np.repeat(weight[kept], count) * self.impact[postings], len(self.ids))


def _kth(score: np.ndarray, k: int) -> float:
    return float(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0.0


class Best:
    """The best k rows of some queries in one task, and the bar that further rows must pass.

    A bar is the score and id of a row that k known rows reach; only what comes strictly before it, by
    higher score or smaller id, can still be among the best.
    """

    def __init__(self, score: np.ndarray, doc: np.ndarray, k: int):
        self.bar_score, self.bar_doc, self.k = score.copy(), doc.copy(), k
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, query: int, doc: np.ndarray, score: np.ndarray) -> None:
        bar, bar_doc = self.bar_score[query], self.bar_doc[query]
        better = (score > bar) | ((score == bar) & (doc < bar_doc))
        if not better.any():
            return
        doc, score = doc[better], score[better]
        if query in self.rows:
            doc, score = np.append(self.rows[query][0], doc), np.append(self.rows[query][1], score)
        top = np.lexsort((doc, -score))[: self.k]
        self.rows[query] = doc[top], score[top]
        if len(top) == self.k:
            self.bar_score[query], self.bar_doc[query] = score[top[-1]], doc[top[-1]]

    def batch(self, query_id: np.ndarray) -> pa.RecordBatch:
        query = np.repeat(query_id[list(self.rows)], [len(doc) for doc, _ in self.rows.values()]) if self.rows else np.zeros(0, np.int64)
        doc, score = (np.concatenate([row[i] for row in self.rows.values()] or [np.zeros(0, kind)]) for i, kind in enumerate((np.int64, np.float64)))
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(doc, mask=doc == _NO_ID), pa.array(score)], ["query_id", "doc_id", "score"])


def _frequencies(documents: DataFrame) -> DataFrame:
    """(term, df) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in portions(texts_of(batch)):
                hashes, first = word_hashes(texts)
                terms, number = np.unique(hashes, return_inverse=True)
                text = np.repeat(np.arange(len(texts)), np.diff(first))
                key = np.sort(text * np.int64(len(terms)) + number)
                n = np.bincount(key[_heads(key)] % max(1, len(terms)), minlength=len(terms))
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], ["term", "df"])

    return documents.select("text").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _sizes(documents: DataFrame) -> tuple[int, float]:
    """(rows, mean number of words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = sum(len(word_hashes(texts)[0]) for _, texts in portions(texts_of(batch)))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([words])], ["n", "words"])

    row = documents.select("text").mapInArrow(run, "n long, words long").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    return row["n"] or 0, max((row["words"] or 0) / max(row["n"] or 0, 1), 1e-9)


def _weighted(queries: DataFrame, documents: DataFrame, rows: int) -> DataFrame:
    """(query_id, terms): the different words of each query, ascending, with their idf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            for row, texts in portions(texts_of(batch)):
                hashes, first = word_hashes(texts)
                text = np.repeat(np.arange(len(texts)), np.diff(first))
                sort = np.lexsort((hashes, text))
                kept = sort[_heads(text[sort], hashes[sort])]
                yield pa.RecordBatch.from_arrays([pa.array(ids[row + text[kept]]), pa.array(hashes[kept].view(np.int64))], ["query_id", "term"])

    words = queries.where("query_id is not null and text is not null").mapInArrow(run, "query_id long, term long")
    idf = F.log1p((F.lit(rows) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    known = words.distinct().join(_frequencies(documents), "term")
    return materialise(known.groupBy("query_id").agg(F.collect_list(F.struct("term", idf.alias("idf"))).alias("terms")))


def search(documents: DataFrame, queries: DataFrame, k: int = 10, shard_bytes: int = SHARD_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, doc_id, score) for queries (query_id, text) over documents (doc_id, text)."""
    rows, mean = _sizes(documents)
    weighted = _weighted(queries.select(F.col("query_id").cast("long").alias("query_id"), "text"), documents, rows)
    terms = weighted.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-2 * 16 * terms // query_bytes))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rounds = _rounds(texts, rows * mean * WORD_SIZE, shard_bytes)
    found = None
    for start in range(0, blocks, PASS_BLOCKS):
        held = [_block(weighted.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n)) for n in range(start, min(blocks, start + PASS_BLOCKS))]
        part = _found(held, rounds, mean, k, shard_bytes)
        found = part if found is None else found.union(part)
    return found.select("query_id", "rank", "doc_id", "score")


def _rounds(texts: DataFrame, size: float, shard_bytes: int) -> list[DataFrame]:
    """The rows in rounds, each ``GROWTH`` times as large as all before; the first about a shard or two."""
    share, shares = 1.0, [1.0]
    while size * share > 2 * shard_bytes:
        share /= GROWTH
        shares.append(share)
    shares.reverse()
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    ends = [0, *(int(share * (1 << 30)) for share in shares)]
    rounds = [texts.where((place >= low) & (place < high)) for low, high in zip(ends, ends[1:])]
    # small rounds are dealt to few tasks, so that shards are large: each costs a search of its own for each query
    tasks = [max(FIRST_TASKS, math.ceil(size * share / shard_bytes)) for share in shares[:-1]]
    return [*(part.repartition(number) for part, number in zip(rounds, tasks)), rounds[-1]]


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(block: DataFrame) -> tuple[np.ndarray, Broadcast]:
    """(ids, broadcast of what ``Queries`` takes) of a block of queries."""
    table = block.toArrow()
    sizes = np.array([len(x) for x in table.column("terms")], np.int64)
    flat = table.column("terms").combine_chunks().flatten() if table.num_rows else None
    terms = flat.field("term").to_numpy().view(np.uint64) if flat is not None else np.zeros(0, np.uint64)
    idf = flat.field("idf").to_numpy() if flat is not None else np.zeros(0)
    terms, one, number = np.unique(terms, return_index=True, return_inverse=True)
    idf = idf[one]  # a word has one idf
    number = number[np.lexsort((number, np.repeat(np.arange(len(sizes)), sizes)))].astype(np.int32)
    ids = table.column("query_id").to_numpy()
    return ids, block.sparkSession.sparkContext.broadcast((ids, np.append(0, np.cumsum(sizes)), number, terms, idf))


def _bars(best: DataFrame | None, held: list[tuple[np.ndarray, Broadcast]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(score, id) of the k-th best row known for each query of each block; 0 where fewer are known."""
    bars = [(np.zeros(len(ids)), np.full(len(ids), _NO_ID)) for ids, _ in held]
    if best is None:
        return bars
    table = best.where(F.col("rank") == k).select("query_id", "score", F.coalesce("doc_id", F.lit(int(_NO_ID))).alias("doc_id")).toArrow()
    query, score, doc = (table.column(name).to_numpy() for name in ("query_id", "score", "doc_id"))
    sort = np.argsort(query)
    query, score, doc = query[sort], score[sort], doc[sort]
    for (ids, _), (bar_score, bar_doc) in zip(held, bars):
        at = np.searchsorted(query, ids)
        known = np.append(query, -1)[at] == ids if len(query) else np.zeros(len(ids), bool)
        known &= at < len(query)
        bar_score[known], bar_doc[known] = score[at[known]], doc[at[known]]
    return bars


def _found(held: list[tuple[np.ndarray, Broadcast]], rounds: list[DataFrame], mean: float, k: int, shard_bytes: int) -> DataFrame:
    """(query_id, doc_id, score, rank): the k best documents for each query of the blocks, over all rounds."""
    best = None
    for rows in rounds:
        if best is not None:
            best = materialise(best)
        found = _searched(rows, [shared for _, shared in held], _bars(best, held, k), mean, k, shard_bytes)
        best = _top(found if best is None else best.drop("rank").union(found), k)
    return best


def _searched(texts: DataFrame, blocks: list[Broadcast], bars: list[tuple[np.ndarray, np.ndarray]], mean: float, k: int, shard_bytes: int) -> DataFrame:
    """(query_id, doc_id, score): each task's k best documents for each query, if they pass its bar."""
    passed = texts.sparkSession.sparkContext.broadcast(bars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(*bar, k) for bar in passed.value]
        for ids, bodies in _shards(batches, shard_bytes):
            shard = Shard(ids, bodies, mean)
            if not len(shard.terms):
                continue
            for block, known in zip(blocks, best):
                queries = Queries(*block.value)
                bar = known.bar_score.copy()
                for query in np.flatnonzero(bar <= 0.0).tolist():
                    rows, scores = shard.best(*queries.words(query), k)
                    known.add(query, shard.ids[rows], scores)
                bar[bar <= 0.0] = np.inf  # those are done
                for query, rows, scores in shard.passing(queries, bar):
                    known.add(query, shard.ids[rows], scores)
        for block, known in zip(blocks, best):
            yield known.batch(block.value[0])

    return texts.mapInArrow(run, "query_id long, doc_id long, score double")


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, list[bytes | None]]]:
    """Ids and texts of shards of about ``most`` bytes, over the batches' borders."""
    ids, bodies, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
            ids.append(_NO_ID if doc_id is None else doc_id)
            bodies.append(text)
            size += len(text or b"") + 1
            if size >= most:
                yield np.array(ids, np.int64), bodies
                ids, bodies, size = [], [], 0
    if ids:
        yield np.array(ids, np.int64), bodies
