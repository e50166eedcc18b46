"""Suffix automata over word sequences, with the smallest document that holds each substring."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """Recognises every run of words of the references that were added.

    After `close`, `least[state]` is the smallest document in which the state's word
    sequences occur.
    """

    def __init__(self):
        self.go: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.least: list[int | None] = [None]

    def _state(self, length: int, go: dict, link: int, least: int | None) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        self.least.append(least)
        return len(self.length) - 1

    def _cloned(self, p: int, word, q: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.go[q]), self.link[q], None)
        self.link[q] = copy
        while p != -1 and self.go[p].get(word) == q:
            self.go[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: Iterable, doc: int) -> None:
        go, link, length, least = self.go, self.link, self.length, self.least
        last = 0
        for word in words:
            q = go[last].get(word)
            if q is not None:  # another reference has this prefix already
                last = q if length[q] == length[last] + 1 else self._cloned(last, word, q)
            else:
                new = self._state(length[last] + 1, {}, 0, None)
                p = last
                while p != -1 and word not in go[p]:
                    go[p][word] = new
                    p = link[p]
                if p != -1:
                    q = go[p][word]
                    link[new] = q if length[q] == length[p] + 1 else self._cloned(p, word, q)
                last = new
            if least[last] is None or doc < least[last]:
                least[last] = doc

    def close(self) -> None:
        """Carry the smallest document from longer to shorter sequences."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up, own = self.link[state], self.least[state]
            if up > 0 and (self.least[up] is None or own < self.least[up]):
                self.least[up] = own

    def least_documents(self, words: Sequence, width: int) -> list[int | None]:
        """For each window of `width` words, the smallest document that holds it, or None.

        These are matching statistics: the longest suffix that the references hold is
        followed word by word; where it spans the window, the window's own state is the
        shortest suffix of that state that is still as long.
        """
        go, link, length = self.go, self.link, self.length
        found: list[int | None] = []
        state = matched = 0
        for at, word in enumerate(words):
            while state and word not in go[state]:
                state = link[state]
                matched = length[state]
            if word in go[state]:
                state = go[state][word]
                matched += 1
            if at + 1 >= width:
                if matched < width:
                    found.append(None)
                else:
                    while length[link[state]] >= width:
                        state = link[state]
                        matched = length[state]
                    found.append(self.least[state])
        return found
