"""Rules as one deterministic automaton over bytes.

Rules are regular expressions of literals, classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{m,n}``. They
become one non-deterministic automaton, whose subsets of states (subset construction) become states of
a deterministic one, which is minimised by partition refinement and kept as a transition array over
classes of equal bytes.
"""

from __future__ import annotations

import numpy as np

NONE = -1


class _Nfa:
    def __init__(self):
        self.eps: list[list[int]] = []
        self.step: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.step.append(None)
        return len(self.eps) - 1


class _Reader:
    """Reads an expression into fragments (start, end) of an automaton; a fragment is built anew for each repeat."""

    def __init__(self, pattern: str, nfa: _Nfa):
        self.text, self.at, self.nfa = pattern, 0, nfa

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def choice(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        if len(options) == 1:
            return options[0]

        def build():
            a, b = self.nfa.state(), self.nfa.state()
            for option in options:
                x, y = option()
                self.nfa.eps[a].append(x)
                self.nfa.eps[y].append(b)
            return a, b

        return build

    def sequence(self):
        items = []
        while self.peek() and self.peek() not in "|)":
            items.append(self.repeat(self.atom()))

        def build():
            a = b = self.nfa.state()
            for item in items:
                x, y = item()
                self.nfa.eps[b].append(x)
                b = y
            return a, b

        return build

    def repeat(self, item):
        c = self.peek()
        if not c or c not in "?*+{":
            return item
        self.take()
        low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(c, (0, 0))
        if c == "{":
            inside = self.text[self.at : self.text.index("}", self.at)]
            self.at += len(inside) + 1
            parts = inside.split(",")
            low = int(parts[0])
            high = low if len(parts) == 1 else int(parts[1]) if parts[1] else None

        def build():
            a = b = self.nfa.state()
            for _ in range(low):
                x, y = item()
                self.nfa.eps[b].append(x)
                b = y
            if high is None:
                x, y = item()
                end = self.nfa.state()
                self.nfa.eps[b] += [x, end]
                self.nfa.eps[y] += [x, end]
                return a, end
            end = self.nfa.state()
            for _ in range(high - low):
                x, y = item()
                self.nfa.eps[b] += [x, end]
                b = y
            self.nfa.eps[b].append(end)
            return a, end

        return build

    def atom(self):
        c = self.take()
        if c == "(":
            inner = self.choice()
            self.take()
            return inner
        return self.letters(frozenset(self.klass() if c == "[" else self.escape() if c == "\\" else {ord(c)}))

    def escape(self) -> set[int]:
        c = self.take()
        if c == "x":
            self.at += 2
            return {int(self.text[self.at - 2 : self.at], 16)}
        return {ord({"n": "\n", "t": "\t"}.get(c, c))}

    def klass(self) -> set[int]:
        found: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = self.escape() if c == "\\" else {ord(c)}
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                c = self.take()
                high = self.escape() if c == "\\" else {ord(c)}
                low = set(range(min(low), min(high) + 1))
            found |= low
        self.take()
        return found

    def letters(self, allowed: frozenset[int]):
        def build():
            a, b = self.nfa.state(), self.nfa.state()
            self.nfa.step[a] = (allowed, b)
            return a, b

        return build


class Automaton:
    """``table[state * classes + of[byte]]`` is the next state, ``accepts[state]`` a bit for each rule."""

    def __init__(self, rules: list[str], search: bool):
        nfa = _Nfa()
        start = nfa.state()
        final = {}
        for k, rule in enumerate(rules):
            a, b = _Reader(rule, nfa).choice()()
            nfa.eps[start].append(a)
            final[b] = 1 << k
        rows = [np.zeros(256, np.int8)] + [np.isin(np.arange(256), list(s[0])).astype(np.int8) for s in nfa.step if s]
        distinct, first, self.of = np.unique(np.stack(rows), axis=1, return_index=True, return_inverse=True)
        self.of = self.of.ravel().astype(np.int32)
        self.classes = len(first)
        closure = [self._closure(nfa, s) for s in range(len(nfa.eps))]
        steps = [(s, nfa.step[s][0], closure[nfa.step[s][1]]) for s in range(len(nfa.eps)) if nfa.step[s]]
        by_class = [{s: to for s, allowed, to in steps if int(byte) in allowed} for byte in first]
        begin = closure[start]
        known, order, table = {begin: 0}, [begin], []
        while len(table) < len(order):
            here, row = order[len(table)], []
            for targets in by_class:
                after = frozenset().union(*(targets[s] for s in here if s in targets))
                if search:
                    after |= begin
                if not after:
                    row.append(NONE)
                    continue
                if after not in known:
                    known[after] = len(order)
                    order.append(after)
                row.append(known[after])
            table.append(row)
        accepts = np.array([sum({final[s] for s in states if s in final}) for states in order], np.int32)
        self._minimise(np.array(table, np.int32), accepts)

    @staticmethod
    def _closure(nfa: _Nfa, state: int) -> frozenset[int]:
        found, todo = {state}, [state]
        while todo:
            for t in nfa.eps[todo.pop()]:
                if t not in found:
                    found.add(t)
                    todo.append(t)
        return frozenset(found)

    def _minimise(self, table: np.ndarray, accepts: np.ndarray) -> None:
        """Refine the partition by what a state accepts until equal blocks have equal successors."""
        block, n = np.unique(accepts, return_inverse=True)[1].ravel(), 0
        while True:
            after = np.where(table == NONE, NONE, block[table])
            _, block = np.unique(np.column_stack([block, after]), axis=0, return_inverse=True)
            block = block.ravel()
            if block.max() + 1 == n:
                break
            n = block.max() + 1
        first = np.zeros(n, np.int64)
        first[block[::-1]] = np.arange(len(block))[::-1]
        rank = np.empty(n, np.int64)  # the block of the first state is 0
        rank[np.argsort(first, kind="stable")] = np.arange(n)
        block, first = rank[block], np.sort(first)
        self.table = np.where(table[first] == NONE, NONE, block[table[first]]).astype(np.int32).ravel()
        self.accepts = accepts[first]

    @property
    def states(self) -> int:
        return len(self.accepts)

    def resets(self) -> np.ndarray:
        """Bytes after which a search is at its start whatever came before."""
        rows = self.table.reshape(-1, self.classes)
        return (rows == 0).all(0)[self.of]

    def longest(self, data: bytes, at: int) -> int:
        """End of the longest match that starts at ``at``, -1 if there is none."""
        state, end, table, of, k, accepts = 0, -1, self._flat, self._of, self.classes, self._accepts
        for p in range(at, len(data)):
            state = table[state * k + of[data[p]]]
            if state < 0:
                break
            if accepts[state]:
                end = p + 1
        return end

    def ready(self) -> Automaton:
        self._flat, self._of, self._accepts = self.table.tolist(), self.of.tolist(), self.accepts.tolist()
        self._first = {b for b in range(256) if self.table[self.of[b]] != NONE}
        return self

    def matches(self, data: bytes) -> list[tuple[int, int]]:
        """Leftmost longest matches that do not overlap, in a short text."""
        found, at = [], 0
        while at < len(data):
            end = self.longest(data, at) if data[at] in self._first else -1
            if end > at:
                found.append((at, end))
                at = end
            else:
                at += 1
        return found

    def lanes(self, body: np.ndarray, starts: np.ndarray, lane: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Scan many texts in one pass; returns lane borders and the rules that each lane has met.

        ``body`` holds the texts end to end, ``starts`` their borders. Lanes end at text borders and after
        bytes that bring the automaton back to its start, so no match spans two. All lanes advance together,
        one byte a step.
        """
        size = len(body)
        if not size:
            return np.zeros(1, np.int64), np.zeros(0, np.int32)
        safe = np.flatnonzero(self.resets()[body]) + 1
        wanted = np.arange(lane, size, lane)
        at = np.searchsorted(safe, wanted)
        borders = np.unique(np.concatenate([starts, safe[at[at < len(safe)]]]))
        borders = borders[(borders >= 0) & (borders <= size)]
        if borders[0] != 0:
            borders = np.concatenate([[0], borders])
        first, length = borders[:-1], np.diff(borders)
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        table, of, k = self.table, self.of, np.int32(self.classes)
        codes = of[body]
        offsets = table * k  # states kept as row offsets
        accepts = self.accepts.astype(np.int32)
        by_offset = np.zeros(self.states * self.classes, np.int32)
        by_offset[:: self.classes] = accepts
        state = np.zeros(len(first), np.int32)
        seen = np.zeros(len(first), np.int32)
        live = np.searchsorted(-length, -np.arange(int(length[0])) - 1, side="right")
        for t in range(int(length[0])):
            n = live[t]
            state = offsets[state[:n] + codes[first[:n] + t]]
            seen[:n] |= by_offset[state]
        out = np.zeros(len(first), np.int32)
        out[order] = seen
        return borders, out
