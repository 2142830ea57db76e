"""Words of many texts as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import numpy as np

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
_LANES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SPACE = 0x20
#: A-Z lower-cased, then digits, a-z and all bytes beyond ASCII; everything else parts words.
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else _SPACE for b in _LOWER)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def hashed_runs(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of each run of bytes, eight bytes at a time. ``data`` needs eight bytes to spare."""
    lanes = np.ndarray((len(data) - 7,), np.uint64, buffer=data, strides=(1,))
    out = length.astype(np.uint64) + np.uint64(seed)
    live, at, left = np.arange(len(start)), start, length
    while len(live):
        step = (out[live] ^ (lanes[at] & _LANES[np.minimum(left, 8)])) * _MIX[0]
        out[live] = (step ^ (step >> np.uint64(29))) * _MIX[1]
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return mixed(out)


class Runs:
    """Where the words of some texts lie in one array of bytes.

    ``first[i]`` to ``first[i + 1]`` are the words of text i; texts that are None have none.
    """

    def __init__(self, texts: list[bytes | None], keep: bytes = WORD_BYTES):
        sizes = np.array([len(text) + 1 if text else 1 for text in texts], np.int64)
        ends = np.cumsum(sizes)
        joined = b"\n".join(text or b"" for text in texts)
        self.data = np.frombuffer(b" " + joined.translate(keep) + b" " * 16, np.uint8)
        inside = self.data != _SPACE
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, end = turns[::2], turns[1::2]
        self.length = end - self.start
        self.first = np.concatenate(([0], np.searchsorted(self.start, ends + 1)))

    def hashes(self) -> np.ndarray:
        return hashed_runs(self.data, self.start, self.length)


def word_hashes(texts: list[bytes | None], keep: bytes = WORD_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text and the end)."""
    runs = Runs(texts, keep)
    return runs.hashes(), runs.first


def portions(texts: list[bytes | None], most: int = 4 << 20):
    """(first row, texts) of runs of whole texts with about ``most`` bytes; a longer text is one."""
    first, size = 0, 0
    for row, text in enumerate(texts):
        size += len(text or b"") + 1
        if size >= most:
            yield first, texts[first : row + 1]
            first, size = row + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def shingle_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive words; of all words if there are fewer, but not none."""
    length = min(length, len(words))
    if not length:
        return words
    count = len(words) - length + 1
    out = words[:count].copy()
    for k in range(1, length):
        out = out * _MIX[0] + words[k : k + count]
    return mixed(out + np.uint64(length))
