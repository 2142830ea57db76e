"""Hard negatives by the threshold algorithm over sorted lists of each dimension.

Candidates are written once to shards in the shared folder: their integer vectors and, for every
dimension, the rows in descending order of that component. Anchors are dealt to blocks of about
``ANCHORS`` and each block searches ``GROUPS`` groups of shards in as many tasks, so what the tasks hand
on is a fixed number of rows for each anchor, however many shards there are.

A search reads a dimension's list from its top for anchors with a positive component there and from its
bottom for those with a negative one, in steps that double. A row met for the first time gets its score
by an integer inner product with the block's anchors. The threshold of an anchor is the sum over all
dimensions of its component times the value that its side of the list has come to: no row that was not
met scores higher. An anchor leaves the search when its threshold is strictly below the kth score of
each of its windows, or below a window's lower end. Best rows are kept from one shard to the next.

Two searches: the first for each anchor's best ``POSITIVES`` rows of its label, the second for the best
``NEGATIVES`` rows of other labels within each positive's window of scores.

Each row is a candidate of its own, so equal ids may appear repeatedly; a row is never its own partner.
Rows without id take no part, as no pair could name them. A vector shorter than another counts as zero
in the dimensions it lacks; an empty vector scores 0. Components are held within the square root of
2**63 / dimensions, so that no score overflows. Scores below 2**53 are computed in doubles, which hold
them exactly, and in 64-bit integers otherwise. Empty tables give no rows.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from coverbay.llm.shared import shared_folder, stored

POSITIVES = 5
NEGATIVES = 3
#: A window's ends in hundredths of the positive's score.
LEAST, MOST = 50, 95
ANCHORS = 1024
GROUPS = 8
#: Components a shard holds.
SHARD_VALUES = 1 << 20
_NONE = np.iinfo(np.int64).min
_EXACT = float(1 << 53)


def typed(embeddings: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part; the vector's components are floor(256 x)."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        F.col(vector).alias("vector"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    most = F.floor(F.sqrt(F.lit(2.0**63) / F.greatest(F.size("vector"), F.lit(1)))).cast("long")
    whole = F.transform("vector", lambda x: F.greatest(F.least(F.floor(256 * x.cast("double")).cast("long"), most), -most))
    return rows.where(finite).select("vec_id", "label", whole.alias("vector"))


def flipped() -> Column:
    """The labels of the query: those of ids divisible by 7 are moved on by one of ten."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def _packed(vectors: list[np.ndarray]) -> np.ndarray:
    """The vectors as rows of equal length, at least one; what is missing is zero."""
    width = max([1, *map(len, vectors)])
    if all(len(vector) == width for vector in vectors):
        return np.stack(vectors) if vectors else np.zeros((0, width), np.int64)
    rows = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(rows, vectors):
        row[: len(vector)] = vector
    return rows


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(column.value_lengths()).cumsum()
    return np.split(flat, ends[:-1]) if len(ends) else []


class Shard:
    """Rows of candidates and, per dimension, their order from the largest component to the smallest."""

    def __init__(self, name: str, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, order: np.ndarray):
        self.name, self.ids, self.labels, self.rows, self.order = name, ids, labels, rows, order

    @classmethod
    def of(cls, name: str, ids, labels, vectors: list[np.ndarray]) -> Shard:
        rows = _packed(vectors)
        order = np.argsort(-rows, axis=0, kind="stable").T
        return cls(name, np.asarray(ids, np.int64), np.asarray(labels, np.int64), rows, np.ascontiguousarray(order))

    def write(self) -> bytes:
        sink = io.BytesIO()
        for array in (self.ids, self.labels, self.rows.astype(np.min_scalar_type(-int(np.abs(self.rows).max(initial=1)))), self.order.astype("<i4")):
            np.save(sink, array, allow_pickle=False)
        return sink.getvalue()

    @classmethod
    def read(cls, name: str, data: bytes) -> Shard:
        source = io.BytesIO(data)
        return cls(name, *(np.load(source, allow_pickle=False) for _ in range(4)))


class Best:
    """The ``k`` best (score, id) of each key, higher scores and then smaller ids first."""

    def __init__(self, keys: int, k: int):
        self.k, self.keys = k, keys
        self.kth, self.kth_id = np.full(keys, _NONE), np.zeros(keys, np.int64)
        self.rows = np.zeros((3, 0), np.int64)  # key, score, id

    def offer(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not keys.size:
            return
        key, score, id_ = np.concatenate([self.rows, [keys, scores, ids]], axis=1)
        order = np.lexsort((id_, -score, key))
        key, score, id_ = key[order], score[order], id_[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        kept = place < self.k
        self.rows = np.stack([key[kept], score[kept], id_[kept]])
        last = place == self.k - 1
        self.kth[key[last]], self.kth_id[key[last]] = score[last], id_[last]


class Anchors:
    """A block of anchors; ``windows`` holds the (lowest, highest) score of each window, in that order."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, shard: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.rows, self.labels, self.shard, self.place = rows, labels, shard, place
        self.low, self.high, self.same = low, high, same
        self.best = [Best(len(rows), k) for _ in range(low.shape[1])]

    def floor(self) -> np.ndarray:
        """The score below which a row cannot matter to any window of the anchor."""
        floors = [np.where(low > high, np.iinfo(np.int64).max, np.maximum(low, best.kth)) for low, high, best in zip(self.low.T, self.high.T, self.best)]
        return np.minimum.reduce(floors)

    def see(self, active: np.ndarray, shard: Shard, new: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of the active anchors with the shard's rows ``new``."""
        equal = self.labels[active, None] == shard.labels[new]
        wanted = equal if self.same else ~equal
        if self.same:
            mine = np.flatnonzero(self.shard[active] == shard.name)
            column = np.searchsorted(new, self.place[active[mine]])
            here = column < len(new)
            here[here] = new[column[here]] == self.place[active[mine[here]]]
            wanted[mine[here], column[here]] = False
        ids = shard.ids[new]
        for low, high, best in zip(self.low.T, self.high.T, self.best):
            lowest = np.maximum(low, best.kth)[active, None]
            row, column = np.nonzero(wanted & (scores >= lowest) & (scores <= high[active, None]))
            key, score, id_ = active[row], scores[row, column].astype(np.int64), ids[column]
            better = (score > best.kth[key]) | (id_ < best.kth_id[key])
            best.offer(key[better], score[better], id_[better])


def search(shard: Shard, anchors: Anchors) -> int:
    """Threshold algorithm over one shard for all anchors; returns the number of rows met."""
    vectors, rows = anchors.rows, shard.rows
    width = min(vectors.shape[1], rows.shape[1])
    vectors, rows, order = vectors[:, :width], rows[:, :width], shard.order[:width]
    bound = np.abs(vectors).max(initial=0).astype(float) * np.abs(rows.astype(np.int64)).max(initial=0) * width
    kind = np.float64 if bound < _EXACT else np.int64
    vectors, rows = vectors.astype(kind), rows.astype(kind)
    above, below = np.maximum(vectors, 0), np.minimum(vectors, 0)
    positive, negative = vectors > 0, vectors < 0
    positive[~vectors.any(axis=1), 0] = True  # an anchor of zeros reads one list
    n, lists = len(rows), np.arange(width)
    met = np.zeros(n, bool)
    active, depth, step = np.arange(len(vectors)), 0, 1
    while active.size and depth < n:
        end = min(n, depth + step)
        tops = order[positive[active].any(axis=0), depth:end].ravel()
        bottoms = order[negative[active].any(axis=0), n - end : n - depth].ravel()
        fresh = np.zeros(n, bool)
        fresh[tops] = fresh[bottoms] = True
        new = np.flatnonzero(fresh & ~met)
        if new.size:
            met[new] = True
            anchors.see(active, shard, new, vectors[active] @ rows[new].T)
        top, bottom = rows[order[:, end - 1], lists], rows[order[:, n - end], lists]
        threshold = above[active] @ top + below[active] @ bottom
        active = active[threshold >= anchors.floor()[active]]
        depth, step = end, 2 * step
    return int(met.sum())


def write_shards(rows: DataFrame, is_anchor: Callable[[np.ndarray], np.ndarray], values: int = SHARD_VALUES) -> tuple[str, DataFrame]:
    """Writes ``typed`` rows to shards; returns the folder and the anchors (anchor_id, label, vector, shard, place).

    The folder's ``list`` holds the paths of each group's shards that finished tasks wrote.
    """
    folder = f"{shared_folder(rows.sparkSession).rstrip('/')}/negatives-{uuid.uuid4().hex}"
    files, root = fs.FileSystem.from_uri(folder)
    files.create_dir(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        part, written = TaskContext.get().partitionId(), 0
        ids, labels, vectors, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal written
            name = f"{uuid.uuid4().hex}.npy"
            shard = Shard.of(name, ids, labels, vectors)
            with files.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(shard.write())
            chosen = np.flatnonzero(is_anchor(shard.ids))
            group = (part + written) % GROUPS
            written += 1
            # one row names the shard, the others are its anchors
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([group, *[None] * len(chosen)], pa.int32()),
                    pa.array([name] * (len(chosen) + 1), pa.string()),
                    pa.array([None, *chosen.tolist()], pa.int64()),
                    pa.array([None, *shard.ids[chosen].tolist()], pa.int64()),
                    pa.array([None, *shard.labels[chosen].tolist()], pa.int64()),
                    pa.array([None, *(vectors[i] for i in chosen)], pa.list_(pa.int64())),
                ],
                ["group", "shard", "place", "anchor_id", "label", "vector"],
            )

        for batch in batches:
            for id_, label, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _vectors(batch.column(2))):
                ids.append(id_), labels.append(label), vectors.append(vector)
                held += max(1, len(vector))
                if held >= values:
                    yield close()
                    ids, labels, vectors, held = [], [], [], 0
        if ids:
            yield close()

    schema = "group int, shard string, place long, anchor_id long, label long, vector array<long>"
    found = stored(rows.select("vec_id", "label", "vector").mapInArrow(run, schema))
    found.where("group IS NOT NULL").select("group", "shard").write.partitionBy("group").parquet(f"{folder}/list")
    return folder, found.where("group IS NULL").drop("group")


def _group_shards(folder: str, group: int) -> Iterator[Shard]:
    files, root = fs.FileSystem.from_uri(folder)
    listed = files.get_file_info(fs.FileSelector(f"{root}/list/group={group}", allow_not_found=True))
    for info in sorted(listed, key=lambda info: info.path):
        if not info.path.endswith(".parquet"):
            continue
        with files.open_input_file(info.path) as source:
            names = pq.read_table(source, columns=["shard"])["shard"].to_pylist()
        for name in names:
            with files.open_input_file(f"{root}/{name}") as source:
                yield Shard.read(name, source.read())


def _searched(anchors: DataFrame, folder: str, same: bool, k: int) -> DataFrame:
    """(anchor, window, score, id): each group's ``k`` best rows in each window of each anchor.

    ``anchors`` holds (anchor, block, label, vector, shard, place, positives), the last one an array of
    scores that set the windows.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[1].as_py()
        table = table.combine_chunks()
        scores = _packed(_vectors(table["positives"].combine_chunks()))
        lengths = np.array([len(v) for v in table["positives"].to_pylist()])
        if same:
            low, high = np.full((table.num_rows, 1), _NONE), np.full((table.num_rows, 1), np.iinfo(np.int64).max)
        else:
            whole, rest = scores // 100, scores % 100
            low, high = LEAST * whole - (-LEAST * rest // 100), MOST * whole + MOST * rest // 100
            high[np.arange(scores.shape[1]) >= lengths[:, None]] = _NONE  # no such positive
        block = Anchors(
            _packed(_vectors(table["vector"].combine_chunks())),
            table["label"].to_numpy(),
            np.array(table["shard"].to_pylist(), object),
            table["place"].to_numpy(),
            low,
            high,
            same,
            k,
        )
        for shard in _group_shards(folder, group):
            search(shard, block)
        names, out = table["anchor"].to_numpy(), []
        for window, best in enumerate(block.best):
            key_, score, id_ = best.rows
            out.append(pa.table({"anchor": names[key_], "window": np.full(len(key_), window, np.int32), "score": score, "id": id_}))
        return pa.concat_tables(out)

    dealt = anchors.withColumn("group", F.explode(F.lit(list(range(GROUPS)))))
    return dealt.groupBy("block", "group").applyInArrow(run, "anchor long, window int, score long, id long")


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all groups; an anchor's window has GROUPS * k rows at most."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = 50) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``typed`` rows.

    Anchors are the rows whose id is divisible by ``every``.
    """
    folder, found = write_shards(rows, lambda ids: ids % every == 0)
    anchors = found.withColumn("anchor", F.monotonically_increasing_id())
    blocks = max(1, -(-found.count() // ANCHORS))
    anchors = stored(anchors.withColumn("block", F.pmod(F.xxhash64("shard", "place"), F.lit(blocks))))
    first = anchors.withColumn("positives", F.array().cast("array<long>"))
    positives = _best(_searched(first, folder, True, POSITIVES), POSITIVES)
    positives = stored(positives.select("anchor", (F.col("rank") - 1).alias("window"), "score", "id"))
    scores = F.transform(F.array_sort(F.collect_list(F.struct("window", "score"))), lambda p: p["score"])  # POSITIVES at most
    second = anchors.join(positives.groupBy("anchor").agg(scores.alias("positives")), "anchor")
    negatives = _best(_searched(second, folder, False, NEGATIVES), NEGATIVES)
    named = positives.select("anchor", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        negatives.join(named, ["anchor", "window"])
        .join(anchors.select("anchor", "anchor_id"), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
