"""Generalised suffix automaton over sequences of words (any hashable symbols)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class SuffixAutomaton:
    """States hold all substrings of the sequences added so far; `link` leads to the longest shorter class."""

    __slots__ = ("length", "link", "next")

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, sequence: Sequence) -> None:
        state = 0
        for symbol in sequence:
            state = self._extend(state, symbol)

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        return len(self.length) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """The state for `longest of p` + symbol, which so far lies inside q."""
        made = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = made
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = made
            p = self.link[p]
        return made

    def _extend(self, last: int, symbol) -> int:
        q = self.next[last].get(symbol)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, symbol, q)
        made = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = made
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[made] = q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)
        return made

    def stream(self, sequence: Sequence) -> Iterator[tuple[int, int]]:
        """Matching statistics: after each symbol the state and the length of the longest suffix known."""
        state = matched = 0
        moves, link, length = self.next, self.link, self.length
        for symbol in sequence:
            while state and symbol not in moves[state]:
                state = link[state]
                matched = length[state]
            to = moves[state].get(symbol)
            if to is None:
                state = matched = 0
            else:
                state, matched = to, matched + 1
            yield state, matched

    def holder(self, state: int, size: int) -> int:
        """The state of the suffix of `size` symbols of a match that ended in `state`."""
        while self.length[self.link[state]] >= size and self.link[state] > 0:
            state = self.link[state]
        return state
