"""Regular expressions over ASCII as one deterministic automaton of transition arrays."""

from __future__ import annotations

import re

import numpy as np

_PARSER = re._parser
_CODES = re._constants


def _folded(byte: int, either_case: bool) -> set[int]:
    letter = chr(byte)
    return {byte, ord(letter.swapcase())} if either_case and letter.isascii() and letter.isalpha() else {byte}


def _set(items, either_case: bool) -> frozenset[int]:
    found: set[int] = set()
    for code, value in items:
        if code is _CODES.LITERAL:
            found |= _folded(value, either_case)
        elif code is _CODES.RANGE:
            for byte in range(value[0], value[1] + 1):
                found |= _folded(byte, either_case)
        else:
            raise ValueError(f"not supported in a set: {code}")
    return frozenset(found)


class Nfa:
    """States with byte edges and empty edges; built for the text read forwards or backwards."""

    def __init__(self, backwards: bool):
        self.backwards = backwards
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, pattern: str) -> tuple[int, int]:
        """Start and end state of a pattern of literals, sets, groups, alternatives and repeats."""
        return self._sequence(list(_PARSER.parse(pattern)), False)

    def _sequence(self, nodes: list, either_case: bool) -> tuple[int, int]:
        start = end = self.state()
        for node in reversed(nodes) if self.backwards else nodes:
            first, last = self._node(node, either_case)
            self.empty[end].append(first)
            end = last
        return start, end

    def _node(self, node, either_case: bool) -> tuple[int, int]:
        code, value = node
        if code is _CODES.SUBPATTERN:
            _, add, _, nodes = value
            return self._sequence(list(nodes), either_case or bool(add & re.IGNORECASE))
        if code is _CODES.BRANCH:
            start, end = self.state(), self.state()
            for nodes in value[1]:
                first, last = self._sequence(list(nodes), either_case)
                self.empty[start].append(first)
                self.empty[last].append(end)
            return start, end
        if code is _CODES.MAX_REPEAT:
            return self._repeat(*value, either_case)
        start, end = self.state(), self.state()
        self.edges[start].append((_set(value if code is _CODES.IN else [node], either_case), end))
        return start, end

    def _repeat(self, least: int, most: int, nodes, either_case: bool) -> tuple[int, int]:
        start = end = self.state()
        copies = least if most is _CODES.MAXREPEAT else most
        exits = [end] if least == 0 else []
        for number in range(1, copies + 1):
            first, last = self._sequence(list(nodes), either_case)
            self.empty[end].append(first)
            end = last
            if number >= least:
                exits.append(end)
        if most is _CODES.MAXREPEAT:
            first, last = self._sequence(list(nodes), either_case)
            self.empty[end].append(first)
            self.empty[last].append(end)
        final = self.state()
        for state in exits:
            self.empty[state].append(final)
        return start, final


class Automaton:
    """``next[state, kind[byte]]`` and ``accepts[state]``, a bit for each pattern; state 0 begins.

    ``anywhere``: a match may begin at every byte, else only at the first. ``dead`` is the state that
    nothing leaves, or -1. Made by subset construction, then by merging equivalent states.
    """

    def __init__(self, patterns: list[str], backwards: bool = False, anywhere: bool = False):
        nfa = Nfa(backwards)
        ends, begin = {}, nfa.state()
        for number, pattern in enumerate(patterns):
            start, end = nfa.add(pattern)
            nfa.empty[begin].append(start)
            ends[end] = 1 << number
        sets = sorted({s for edges in nfa.edges for s, _ in edges}, key=sorted)
        rows = [tuple(byte in s for s in sets) for byte in range(256)]
        kinds = sorted(set(rows))
        self.kind = np.array([kinds.index(row) for row in rows], np.uint8)
        table, accepts = self._subsets(nfa, begin, ends, [rows.index(kind) for kind in kinds], anywhere)
        self.next, self.accepts = self._minimised(table, accepts)
        stuck = (self.next == np.arange(len(self.next))[:, None]).all(1) & (self.accepts == 0)
        self.dead = int(np.flatnonzero(stuck)[0]) if stuck.any() else -1

    @staticmethod
    def _subsets(nfa: Nfa, begin: int, ends: dict[int, int], examples: list[int], anywhere: bool):
        def closed(states: set[int]) -> frozenset[int]:
            todo, seen = list(states), set(states)
            while todo:
                for state in nfa.empty[todo.pop()]:
                    if state not in seen:
                        seen.add(state)
                        todo.append(state)
            return frozenset(state for state in seen if nfa.edges[state] or state in ends)

        first = closed({begin})
        known, order, table = {first: 0}, [first], []
        for states in order:  # grows meanwhile
            row = []
            for byte in examples:
                reached = {to for state in states for s, to in nfa.edges[state] if byte in s}
                target = closed(reached | ({begin} if anywhere else set()))
                if target not in known:
                    known[target] = len(order)
                    order.append(target)
                row.append(known[target])
            table.append(row)
        accepts = [sum(ends.get(state, 0) for state in states) for states in order]
        return np.array(table, np.int64), np.array(accepts, np.int64)

    @staticmethod
    def _minimised(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States that no text tells apart become one; classes are refined until they hold still."""
        block, count = np.unique(accepts, return_inverse=True)[1], 0
        while block.max() + 1 != count:
            count = block.max() + 1
            block = np.unique(np.column_stack((block, block[table])), axis=0, return_inverse=True)[1].ravel()
        # number the classes as they are first met, so state 0 stays the first
        _, first = np.unique(block, return_index=True)
        rank = np.argsort(np.argsort(first))
        heads = np.sort(first)
        return rank[block[table[heads]]], accepts[heads]


def scanned_backwards(automaton: Automaton, data: np.ndarray, lanes: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Where the automaton, fed the bytes from the last to the first, accepts: (positions, accepts).

    The bytes are cut into lanes that advance together, one array operation per byte. A lane starts
    from state 0; where its right neighbour ended in another state, it is read again from there until
    it agrees with its first reading. So each byte is read once, and a few near the cuts twice.
    """
    long = max(1, -(-len(data) // lanes))
    lanes = -(-len(data) // long) if len(data) else 0
    if not lanes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = automaton.next.shape[1]
    padded = np.full(lanes * long, automaton.kind[0xFF], np.uint8)
    padded[: len(data)] = automaton.kind[data]
    columns = np.ascontiguousarray(padded.reshape(lanes, long).T)
    step = (automaton.next * kinds).astype(np.int32).ravel()
    states = np.empty((long, lanes), np.int32)
    state = np.zeros(lanes, np.int32)
    for at in range(long - 1, -1, -1):
        state = step[state + columns[at]]
        states[at] = state
    begun = np.zeros(lanes, np.int32)
    while True:
        due = np.concatenate((states[0, 1:], [np.int32(0)]))
        live = np.flatnonzero(due != begun)
        if not len(live):
            break
        begun[live] = due[live]
        state = due[live]
        for at in range(long - 1, -1, -1):
            state = step[state + columns[at, live]]
            changed = state != states[at, live]
            live, state = live[changed], state[changed]
            if not len(live):
                break
            states[at, live] = state
    accepts = automaton.accepts[states // kinds].T.ravel()[: len(data)]
    positions = np.flatnonzero(accepts)
    return positions, accepts[positions]
