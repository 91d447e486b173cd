"""A minimal acyclic transducer from words to numbers, in one flat file that can be memory-mapped.

Words with the same endings share states. Each arc carries a number; the sum
along the path of a word is the word's place in the sorted list, and a table
holds the ids of the word at that place.
"""

from __future__ import annotations

import mmap
from array import array
from functools import cached_property

import numpy as np

MAGIC = 0x4C455832
HEAD = 8  # numbers before the parts


class _Minimiser:
    """Builds the smallest automaton of words that come in sorted order: a state is replaced as soon as it is complete."""

    def __init__(self) -> None:
        self.known: dict[tuple, int] = {}
        self.states: list[tuple] = []  # (final, ((label, target), ...))
        self.path: list[list] = [[False, []]]  # states of the last word: [final, [(label, target)]]
        self.last = b""

    def add(self, word: bytes) -> None:
        if self.last and word <= self.last:
            raise ValueError("words must be sorted and different")
        shared = 0
        while shared < min(len(word), len(self.last)) and word[shared] == self.last[shared]:
            shared += 1
        self._close(shared)
        self.path += [[False, []] for _ in range(len(word) - shared)]
        self.path[-1][0] = True
        self.last = word

    def _close(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            final, arcs = self.path.pop()
            self.path[-1][1].append((self.last[len(self.path) - 1], self._number(final, arcs)))

    def _number(self, final: bool, arcs: list) -> int:
        state = (final, tuple(arcs))
        if state not in self.known:
            self.known[state] = len(self.states)
            self.states.append(state)
        return self.known[state]

    def finish(self) -> int:
        self._close(0)
        return self._number(*self.path.pop())


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The file for these words and their ids. Its size is bounded by the number of words."""
    words = sorted(entries)
    automaton = _Minimiser()
    for word in words:
        automaton.add(word)
    root = automaton.finish()
    below = [0] * len(automaton.states)  # words from each state; targets always have lower numbers
    first, final = array("I", [0]), array("I")
    labels, targets, numbers = bytearray(), array("I"), array("I")
    for i, (is_final, arcs) in enumerate(automaton.states):
        passed = int(is_final)
        for label, target in arcs:
            labels.append(label)
            targets.append(target)
            numbers.append(passed)
            passed += below[target]
        below[i] = passed
        final.append(int(is_final))
        first.append(len(labels))
    starts, ids = array("I", [0]), array("I")
    for word in words:
        ids.extend(entries[word])
        starts.append(len(ids))
    parts = [first, final, targets, numbers, starts, ids]
    head = array("I", [MAGIC, root, *(len(part) for part in parts)])
    return head.tobytes() + b"".join(part.tobytes() for part in parts) + bytes(labels)


class Lexicon:
    """Look words up in a compiled file. The pages are shared by all processes that map the file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.file = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        head = array("I", self.file[: HEAD * 4])
        if head[0] != MAGIC:
            raise ValueError("this is not a lexicon file")
        at, parts = HEAD * 4, []
        for size in head[2:]:
            parts.append(memoryview(self.file)[at : at + size * 4].cast("I"))
            at += size * 4
        self.root, self.labels_at = head[1], at
        self.first, self.final, self.targets, self.numbers, self.starts, self.ids = parts

    def find(self, word: bytes) -> list[int] | None:
        """The ids of a word, or nothing if it is not in the lexicon."""
        state, place = self.root, 0
        first, targets, numbers, base, labels = self.first, self.targets, self.numbers, self.labels_at, self.file
        for i in range(len(word)):
            arc = labels.find(word[i : i + 1], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            place += numbers[arc]
            state = targets[arc]
        if not self.final[state]:
            return None
        return self.ids[self.starts[place] : self.starts[place + 1]].tolist()

    @cached_property
    def arcs(self) -> tuple[np.ndarray, ...]:
        """State and label of every arc as one ascending number, and views of the mapped file: nothing else is copied."""
        first, labels = np.asarray(self.first, np.int64), np.frombuffer(self.file, np.uint8, offset=self.labels_at)
        keys = np.repeat(np.arange(len(first) - 1) << 8, np.diff(first)) | labels
        return keys, *(np.asarray(part) for part in (self.targets, self.numbers, self.final))

    def find_many(self, words: list[bytes]) -> list[bytes | None]:
        """Per word its ids as 32-bit numbers side by side, or nothing: all words take a step at a time."""
        keys, targets, numbers, final = self.arcs
        letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(sizes) - sizes
        state, place = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        alive, step = np.arange(len(words)), 0
        walking = alive[sizes > 0] if len(keys) else alive[:0]
        state[sizes > 0] = state[sizes > 0] if len(keys) else -1
        while len(walking):
            wanted = state[walking] << 8 | letters[begin[walking] + step]
            arc = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            there = keys[arc] == wanted
            state[walking[~there]] = -1
            walking, arc = walking[there], arc[there]
            state[walking] = targets[arc]
            place[walking] += numbers[arc]
            step += 1
            walking = walking[sizes[walking] > step]
        known = state >= 0
        known[known] = final[state[known]] > 0
        found: list[bytes | None] = [None] * len(words)
        for i in np.flatnonzero(known).tolist():
            found[i] = self.ids[self.starts[place[i]] : self.starts[place[i] + 1]].tobytes()
        return found
