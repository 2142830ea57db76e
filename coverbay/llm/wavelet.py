"""Token ids of whole texts in wavelet matrix files, which answer queries without being decoded.

Documents are put in ranges of doc_id. A task encodes its rows in that order, ends each with ``END`` and
writes files of about ``SHARD_TOKENS`` ids; a document is never cut. Only the texts are shuffled. The
files' places in the order of all ids are running sums over their manifest, one row per file.

A file holds one bit-plane per bit of its largest id. The topmost plane has the ids' top bits in the
order of the text; each following plane has the next bit in the order that the plane above gives when
its zeros come first and its ones after. A plane keeps the number of ones before each block of 512 bits
and only the blocks that hold both zeros and ones, so runs of equal bits take no room. ``WaveletFile``
answers access, rank, select, counts and places of an id from the planes, and decodes all ids by undoing
the planes from the last to the first. Texts may hold the id ``END`` themselves, so the documents' ids
and lengths are in the file.

NULL is an empty text: its only id is ``END``. Missing ids come first, rows with equal ids are in the
order of their texts. An empty table gives no rows. One document at a time is held whole with its ids.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from coverbay.llm.shared import materialise, shared_folder

VOCABULARY = "byte_bpe_50k.json"
END = 2
SHARD_TOKENS = 1 << 22
MAGIC = b"WMTOKEN1"
BLOCK_BITS = 512
#: Encoded words a Python worker remembers, and bytes of whole encoded texts.
MOST_WORDS = 5 << 18
MOST_TEXTS = 8 << 20
MOST_TASKS = 10_000
_PLACES = 1 << 14
_SLICE = 1 << 16

_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "-.,;:!?#$%&*()/=+_"
# The vocabulary's rules always cut a text before white space that follows something else, after a single line
# end, and between a letter and a mark, so pieces between such places are encoded apart with equal results.
_CUT = re.compile(rf"(?<=\S)(?=\s)|(?<=\S\n)(?=\S)|(?<=[{_LETTERS}])(?=[{_MARKS}])|(?<=[{_MARKS}])(?=[{_LETTERS}])")
# One word for those rules, so that the model alone gives its ids; and a word with marks after it.
_WORD = re.compile(f" ?[{_LETTERS}]+")
_MARKED = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)")


def _byte_letters() -> dict[int, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it is visible, else from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: byte for byte in visible} | {byte: 256 + n for n, byte in enumerate(hidden)}


class _Pieces(dict):
    """Ids of pieces, each as little-endian 32-bit integers; a new one is encoded when it is asked for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.space = chr(self.letters[0x20])

    def word(self, word: str) -> bytes:
        """Ids of letters with or without a space before them."""
        letters = word.replace(" ", self.space) if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        tokens = self.model.tokenize(letters)
        return struct.pack(f"<{len(tokens)}I", *[token.id for token in tokens])

    def __missing__(self, piece: str) -> bytes:
        if _WORD.fullmatch(piece):
            found = self.word(piece)
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            found = struct.pack(f"<{len(ids)}I", *ids)
        self[piece] = found
        return found


class _MoreSpace(Exception):
    """A text with a space at an end or beside other white space, which isn't such a place."""


class _Spaced(dict):
    """Ids of what stands between two single spaces, the one before it included."""

    def __init__(self, pieces: _Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, text: str) -> bytes:
        marked = _MARKED.fullmatch(text)
        if marked is None:
            if text != text.strip() or not text:
                raise _MoreSpace
            found = b"".join(map(self.pieces.__getitem__, _CUT.split(" " + text)))
        elif marked[2]:
            found = self[marked[1]] + self.pieces[marked[2]]
        else:
            found = self.pieces.word(" " + text)
        self[text] = found
        return found


class Encoder:
    """Ids of whole texts, as little-endian 32-bit integers; remembers words and repeated texts."""

    def __init__(self, path: str):
        self.pieces = _Pieces(path)
        self.spaced = _Spaced(self.pieces)
        self.texts: dict[str, bytes] = {}
        self.kept = 0

    @classmethod
    def of_process(cls, path: str) -> Encoder:
        """The encoder of this Python worker, so that its later tasks find what earlier ones have learned."""
        kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
        if getattr(kept, "path", None) != path:
            kept.path, kept.encoder = path, cls(path)
        return kept.encoder

    def _joined(self, pieces: list[str], learned: dict[str, bytes]) -> bytes:
        found = []
        for start in range(0, len(pieces), _SLICE):  # so that words of a very long text are forgotten as well
            for words in (learned, self.pieces):
                if len(words) > MOST_WORDS:
                    words.clear()
            found.append(b"".join(map(learned.__getitem__, pieces[start : start + _SLICE])))
        return b"".join(found)

    def _encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                return self._joined(_CUT.split(first), self.pieces) + self._joined(rest, self.spaced)
            except _MoreSpace:
                pass
        return self._joined(_CUT.split(text), self.pieces)

    def encode(self, text: str) -> bytes:
        found = self.texts.get(text)
        if found is None:
            found = self._encode(text) if text else b""
            size = len(found) + 4 * len(text)
            if size <= MOST_TEXTS // 16:
                if self.kept + size > MOST_TEXTS:
                    self.texts.clear()
                    self.kept = 0
                self.texts[text] = found
                self.kept += size
        return found


def _plane(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ones before each block, mixed blocks) of a plane."""
    packed = np.packbits(bits, bitorder="little")
    padded = np.zeros(-(-len(packed) // (BLOCK_BITS // 8)) * (BLOCK_BITS // 8), np.uint8)
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, BLOCK_BITS // 8)
    ones = np.bitwise_count(blocks.view(np.uint64)).sum(axis=1, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
    return before, blocks[(ones > 0) & (ones < BLOCK_BITS)]


def write(ids: np.ndarray, lengths: list[int], doc_ids: list[int | None]) -> Iterator[bytes]:
    """A file of ``ids``, the ids of documents one after the other."""
    levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    current = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    planes, zeros = [], []
    for level in range(levels - 1, -1, -1):
        bits = (current & current.dtype.type(1 << level)) != 0
        planes.append(_plane(bits))
        low = current.take(np.flatnonzero(~bits))  # much faster than a mask
        zeros.append(len(low))
        current = np.concatenate([low, current.take(np.flatnonzero(bits))])
    names = zlib.compress(json.dumps(doc_ids).encode(), 1)
    sizes = zlib.compress(np.array(lengths, "<i8").tobytes(), 1)
    head = {"n": len(ids), "zeros": zeros, "mixed": [len(mixed) for _, mixed in planes], "docs": [len(names), len(sizes)]}
    text = json.dumps(head).encode()
    yield MAGIC + len(text).to_bytes(4, "little") + text + names + sizes
    for before, mixed in planes:
        yield before.tobytes()
        yield mixed.tobytes()


class WaveletFile:
    """One file, read whole; all queries work on the planes."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of token ids")
        at = len(MAGIC) + 4
        size = int.from_bytes(data[at - 4 : at], "little")
        head = json.loads(data[at : at + size])
        at += size
        self.n, self.zeros = head["n"], head["zeros"]
        names, sizes = head["docs"]
        self.doc_ids = json.loads(zlib.decompress(data[at : at + names]))
        lengths = np.frombuffer(zlib.decompress(data[at + names : at + names + sizes]), "<i8")
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        at += names + sizes
        blocks = -(-self.n // BLOCK_BITS)
        self.before, self.mixed, self.place = [], [], []
        for count in head["mixed"]:
            before = np.frombuffer(data, "<u4", blocks + 1, at).astype(np.int64)
            at += 4 * (blocks + 1)
            mixed = np.frombuffer(data, np.uint8, count * BLOCK_BITS // 8, at).reshape(count, BLOCK_BITS // 8)
            at += mixed.size
            ones = np.diff(before)
            self.before.append(before)
            self.mixed.append(mixed)
            # the mixed block's number; -1 if all bits are zeros, -2 if all are ones
            has_both = (ones > 0) & (ones < BLOCK_BITS)
            self.place.append(np.where(has_both, np.cumsum(has_both) - 1, np.where(ones > 0, -2, -1)))

    def _ones(self, level: int, places: np.ndarray) -> np.ndarray:
        """How many of the bits before each place are one."""
        block, within = places // BLOCK_BITS, places % BLOCK_BITS
        result = self.before[level][block]
        inside = np.flatnonzero(within)
        where = self.place[level][block[inside]]
        result[inside[where == -2]] += within[inside[where == -2]]
        both = inside[where >= 0]
        if both.size:
            bits = np.unpackbits(self.mixed[level][where[where >= 0]], axis=1, bitorder="little")
            result[both] += (bits * (np.arange(BLOCK_BITS) < within[both, None])).sum(axis=1, dtype=np.int64)
        return result

    def access(self, places) -> np.ndarray:
        """The ids at these places."""
        at = np.array(places, np.int64)
        if at.size > _PLACES:
            return np.concatenate([self.access(at[i : i + _PLACES]) for i in range(0, at.size, _PLACES)])
        ids = np.zeros(at.shape, np.int64)
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level, at)
            bit = self._ones(level, at + 1) - ones
            ids = ids << 1 | bit
            at = np.where(bit == 1, zeros + ones, at - ones)
        return ids

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` among places low..high-1 lie below the last plane."""
        if token >> len(self.zeros):
            return 0, 0
        ends = np.array([low, high], np.int64)
        for level, zeros in enumerate(self.zeros):
            ones = self._ones(level, ends)
            ends = zeros + ones if token >> (len(self.zeros) - 1 - level) & 1 else ends - ones
        return int(ends[0]), int(ends[1])

    def rank(self, token: int, place: int) -> int:
        """Occurrences of ``token`` before ``place``."""
        return self.count(token, 0, place)

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        first, last = self._range(token, low, self.n if high is None else high)
        return last - first

    def _nth(self, level: int, bit: int, wanted: int) -> int:
        """The place of the bit number ``wanted``, from 0, that equals ``bit``."""
        total = np.arange(len(self.before[level]), dtype=np.int64) * BLOCK_BITS
        found = self.before[level] if bit else total - self.before[level]
        block = int(np.searchsorted(found, wanted, side="right")) - 1
        where = self.place[level][block]
        if where < 0:
            return block * BLOCK_BITS + wanted - int(found[block])
        bits = np.unpackbits(self.mixed[level][where], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[wanted - int(found[block])])

    def select(self, token: int, number: int) -> int:
        """The place of the occurrence ``number``, from 0, of ``token``."""
        first, last = self._range(token, 0, self.n)
        if not 0 <= number < last - first:
            raise IndexError(f"{token} has {last - first} occurrences")
        at = first + number
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - level) & 1
            at = self._nth(level, bit, at - self.zeros[level] if bit else at)
        return at

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, number) for number in range(self.count(token))]

    def document(self, number: int) -> np.ndarray:
        """The ids of one document, without those of any other."""
        return self.access(np.arange(self.starts[number], self.starts[number + 1]))

    def _bits(self, level: int) -> np.ndarray:
        place = self.place[level]
        blocks = np.zeros((len(place), BLOCK_BITS // 8), np.uint8)
        blocks[place == -2] = 255
        blocks[place >= 0] = self.mixed[level]
        return np.unpackbits(blocks, bitorder="little")[: self.n].view(bool)

    def decoded(self) -> np.ndarray:
        """All ids, each plane undone once."""
        kind = np.uint16 if len(self.zeros) <= 16 else np.uint32
        below = np.zeros(self.n, kind)
        for level in range(len(self.zeros) - 1, -1, -1):
            bits, zeros = self._bits(level), self.zeros[level]
            current = np.empty(self.n, kind)
            current[np.flatnonzero(~bits)] = below[:zeros]
            current[np.flatnonzero(bits)] = below[zeros:] | kind(1 << (len(self.zeros) - 1 - level))
            below = current
        return below


def _manifest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("path", pa.string()), ("part", pa.int64()), ("number", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64())]
    arrays = [pa.array([row[i] for row in rows], kind) for i, (_, kind) in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in kinds])


def write_files(documents: DataFrame, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encodes ``documents`` (doc_id, text) into files; returns (path, docs, tokens, start).

    ``tokenizer`` is the path of a tokenizer's JSON file on every executor.
    """
    spark = documents.sparkSession
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(VOCABULARY)
    folder = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    files, place = fs.FileSystem.from_uri(folder)
    files.create_dir(place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        encoder, part = Encoder.of_process(tokenizer), TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"  # only files that a finished task reports are read
        done, held, doc_ids, size = [], [], [], 0
        end = np.array([END], "<u4").tobytes()

        def close() -> None:
            target = f"{name}-{len(done)}.wm"
            ids = np.frombuffer(b"".join(held), "<u4")
            lengths = [len(ids) // 4 for ids in held]
            with files.open_output_stream(f"{root}/{target}", compression=None) as out:
                for piece in write(ids, lengths, doc_ids):
                    out.write(piece)
            done.append((f"{folder}/{target}", part, len(done), len(doc_ids), len(ids)))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append(encoder.encode(text.as_py() or "") + end)
                doc_ids.append(doc_id)
                size += len(held[-1]) // 4
                if size >= shard_tokens:
                    close()
                    held, doc_ids, size = [], [], 0
        if held:
            close()
        yield _manifest(done)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    keys = ["doc_id", "sum", "text"]
    rows = rows.withColumn("sum", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    ranges = rows.repartitionByRange("doc_id", "sum", "tie").sortWithinPartitions(*keys).select("doc_id", "text")
    written = materialise(ranges.mapInArrow(run, "path string, part long, number long, docs long, tokens long"))
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    start = F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long")
    return materialise(written.select("path", "docs", "tokens", start.alias("start")))


def read_files(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids): the documents of all files.

    ids are little-endian 32-bit integers and ids_crc32 their checksum; without ``with_ids`` only the
    checksum leaves the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                files, path = fs.FileSystem.from_uri(name)
                with files.open_input_file(path) as source:
                    file = WaveletFile(source.read())
                ids, starts = file.decoded().astype("<u4"), file.starts
                at = 0
                while at < len(file.doc_ids):  # about 1 M ids at a time
                    to = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 20))))
                    to = min(to, len(file.doc_ids))
                    cut = [ids[starts[i] : starts[i + 1]] for i in range(at, to)]
                    columns = {
                        "doc_id": pa.array(file.doc_ids[at:to], pa.int64()),
                        "start": pa.array(starts[at:to] + first, pa.int64()),
                        "n_tokens": pa.array(np.diff(starts[at : to + 1]), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(part) for part in cut], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([part.tobytes() for part in cut], pa.binary())
                    yield pa.RecordBatch.from_pydict(columns)
                    at = to

    files = manifest.select("path", "start")
    files = files.repartition(max(1, min(files.count(), MOST_TASKS)))
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
