"""Secret scans with one automaton for all rules.

All rules' expressions are compiled, read backwards, into a single minimal automaton. One pass over the
bytes from the last to the first says at each position which rules have a match that starts there. From
these positions a second automaton of the same rules reads forwards to a match's longest end. Matches of
a rule are taken from the left and don't overlap; those too short are dropped after they are taken.

The rules' expressions must be such that the longest match is also the one that a backtracking matcher
finds, as the ones here are. Spans count code points, end exclusive.

NULL and empty texts have no spans. A text is scanned whole, whatever its length; a task holds about
8 MB of texts, or one text if that is longer. Repeated rows are scanned alike. The columns of the
documents pass through; ``spans`` gets a longer name where it would clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from coverbay.llm.automaton import Automaton, scanned_backwards
from coverbay.llm.features import texts_of
from coverbay.llm.shared import fresh
from coverbay.llm.wordhash import portions


class Rule(NamedTuple):
    kind: str
    pattern: str
    least: int  # characters of the match, or of the group ``value``
    value: int = 0


#: Base rules first. A run of hex digits counts from 32 on; runs are taken whole either way.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
)
BASE = 3


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        patterns = [rule.pattern for rule in rules]
        self.starts = Automaton(patterns, backwards=True, anywhere=True)
        self.ends = Automaton(patterns)
        self.steps, self.kind = self.ends.next.tolist(), self.ends.kind.tolist()
        self.accepts = self.ends.accepts.tolist()
        self.groups = [re.compile(rule.pattern.encode()) for rule in rules]

    def _end(self, text: bytes, start: int, rule: int) -> int:
        state, last, bit = 0, start, 1 << rule
        for at in range(start, len(text)):
            state = self.steps[state][self.kind[text[at]]]
            if state == self.ends.dead:
                break
            if self.accepts[state] & bit:
                last = at + 1
        return last

    def _long_enough(self, text: bytes, start: int, end: int, rule: int) -> bool:
        if not self.rules[rule].value:
            return end - start >= self.rules[rule].least
        value = self.groups[rule].fullmatch(text, start, end)[self.rules[rule].value]
        return len(value) >= self.rules[rule].least

    def _spans(self, text: bytes, positions: list[int], accepts: list[int]) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, ascending."""
        found, free = [], [0] * len(self.rules)
        for start, which in zip(positions, accepts):
            for rule in range(len(self.rules)):
                if which >> rule & 1 and start >= free[rule]:
                    end = free[rule] = self._end(text, start, rule)
                    if self._long_enough(text, start, end, rule):
                        found.append((start, rule, end))
        return found

    def scan(self, texts: list[bytes | None]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of each text's spans by start, then rule, in code points."""
        joined = b"\xff".join(text or b"" for text in texts)
        position, accepts = scanned_backwards(self.starts, np.frombuffer(joined, np.uint8))
        sizes = np.array([len(text or b"") + 1 for text in texts], np.int64)
        begin = np.cumsum(sizes) - sizes
        edges = np.searchsorted(position, np.append(begin, begin[-1] + sizes[-1] if len(texts) else 0))
        out: list[list[tuple[str, int, int]]] = []
        for row, text in enumerate(texts):
            here = slice(edges[row], edges[row + 1])
            spans = self._spans(text, (position[here] - begin[row]).tolist(), accepts[here].tolist()) if text else []
            out.append(self._in_code_points(text, spans) if spans else [])
        return out

    def _in_code_points(self, text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
        places, at, count = {}, 0, 0
        for place in sorted({p for start, _, end in spans for p in (start, end)}):
            count += len(text[at:place].decode())
            at = place
            places[place] = count
        return [(self.rules[rule].kind, places[start], places[end]) for start, rule, end in spans]


def find_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """The documents with their spans (array of kind, start, end), and that column's name."""
    name = fresh(documents.columns, "spans")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    span = T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType())
    schema = T.StructType([*documents.schema.fields]).add(name, T.ArrayType(span))

    scanner = Scanner(rules)  # compiled once; tasks get its arrays, about 0.2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for _, texts in portions(texts_of(batch)) for row in scanner.scan(texts)]
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=[*batch.schema.names, name])

    return documents.mapInArrow(run, schema), name


def listed(spans):
    """kind:start:end of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
