"""A suffix automaton of several sequences, for longest matches of a stream of symbols."""

from __future__ import annotations


class SuffixAutomaton:
    """All stretches of all sequences. States are numbers, 0 is the empty stretch.

    A state stands for stretches with the same ends in the sequences: the longest has
    ``length[state]`` symbols, the shortest one more than ``length[link[state]]``.
    ``step`` holds the moves, keyed by ``state * symbols + symbol``.
    """

    def __init__(self, symbols: int):
        self.symbols = max(1, symbols)
        self.length, self.link = [0], [-1]
        self.step: dict[int, int] = {}
        self._out: list[list[int]] = [[]]

    def _state(self, length: int) -> int:
        self.length.append(length)
        self.link.append(0)
        self._out.append([])
        return len(self.length) - 1

    def _move(self, state: int, symbol: int, to: int) -> None:
        self.step[state * self.symbols + symbol] = to
        self._out[state].append(symbol)

    def _split(self, state: int, symbol: int, to: int) -> int:
        """The state of exactly the stretches one symbol longer than ``state``'s, parted from ``to``."""
        step, n = self.step, self.symbols
        part = self._state(self.length[state] + 1)
        for s in self._out[to]:
            self._move(part, s, step[to * n + s])
        self.link[part], self.link[to] = self.link[to], part
        while state >= 0 and step.get(state * n + symbol) == to:
            step[state * n + symbol] = part
            state = self.link[state]
        return part

    def _extend(self, last: int, symbol: int) -> int:
        step, n = self.step, self.symbols
        known = step.get(last * n + symbol)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, symbol, known)
        new = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and at * n + symbol not in step:
            self._move(at, symbol, new)
            at = self.link[at]
        if at >= 0:
            to = step[at * n + symbol]
            self.link[new] = to if self.length[to] == self.length[at] + 1 else self._split(at, symbol, to)
        return new

    def add(self, sequence: list[int]) -> int:
        """Take a sequence in; the state of the whole of it."""
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
        return last

    def finished(self) -> SuffixAutomaton:
        """Without what only building needs."""
        self._out = []
        return self

    def follow(self, state: int, matched: int, symbol: int) -> tuple[int, int]:
        """State and length of the longest match after one more symbol."""
        step, link, n = self.step, self.link, self.symbols
        to = step.get(state * n + symbol)
        while to is None and state:
            state = link[state]
            matched = self.length[state]
            to = step.get(state * n + symbol)
        return (to, matched + 1) if to is not None else (0, 0)
