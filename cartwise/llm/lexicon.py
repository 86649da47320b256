"""Minimal acyclic transducer over words, as flat arrays that can be memory-mapped.

Words are byte strings added in sorted order; equal right languages share
one state (incremental construction with a register of states), so common
suffixes are stored once.  Every arc carries how many words precede it within its
state, so a walk adds up to the word's rank, and the rank addresses the
output: a slice of the id table.  The file is one header and five
arrays; ``Lexicon`` walks many words at once, one numpy step per letter.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"MATL0001"


class _State:
    __slots__ = ("arcs", "final", "words", "number")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final, self.words, self.number = False, -1, -1

    def key(self):
        return self.final, tuple((b, id(s)) for b, s in self.arcs.items())


def _minimal(words: list[bytes]) -> _State:
    root, register, path, last = _State(), {}, [], b""
    # path: (state, letter, child) below the root for the word added last, not yet shared

    def share(down_to: int) -> None:
        while len(path) > down_to:
            parent, letter, child = path.pop()
            parent.arcs[letter] = register.setdefault(child.key(), child)

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        share(common)
        at = path[-1][2] if path else root
        for letter in word[common:]:
            child = _State()
            at.arcs[letter] = child
            path.append((at, letter, child))
            at = child
        at.final, last = True, word
    share(0)
    return root


def compile_lexicon(outputs: dict[bytes, list[int]]) -> bytes:
    """The automaton of the words with their id outputs, as one byte string."""
    words = sorted(w for w in outputs if w)
    root = _minimal(words)
    order, todo = [], [root]
    while todo:  # states numbered from the root; the walk needs no recursion
        s = todo.pop()
        if s.number < 0:
            s.number = len(order)
            order.append(s)
            todo.extend(s.arcs.values())
    pending = [root]
    while pending:  # words below a state, children first
        s = pending[-1]
        if s.words >= 0:
            pending.pop()
            continue
        missing = [c for c in s.arcs.values() if c.words < 0]
        if missing:
            pending.extend(missing)
        else:
            s.words = int(s.final) + sum(c.words for c in s.arcs.values())
            pending.pop()
    keys, targets, before = [], [], []
    for s in order:
        n = int(s.final)
        for letter, child in s.arcs.items():
            keys.append(s.number << 8 | letter)
            targets.append(child.number)
            before.append(n)
            n += child.words
    rank = np.argsort(keys, kind="stable")
    ids = [outputs[w] for w in words]
    parts = [np.array(keys, np.int64)[rank], np.array(targets, np.int64)[rank], np.array(before, np.int64)[rank],
             np.array([s.final for s in order], np.int64),
             np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64),
             np.array([i for x in ids for i in x], np.int64)]
    head = np.array([len(p) for p in parts], np.int64)
    return MAGIC + head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """Read-only view of a compiled lexicon: ``Lexicon.open(path)`` memory-maps the file."""

    def __init__(self, buffer):
        if bytes(buffer[:8]) != MAGIC:
            raise ValueError("not a lexicon file")
        data = np.frombuffer(buffer, np.int64, offset=8) if isinstance(buffer, bytes) else buffer[8:].view(np.int64)
        sizes, at, parts = data[:6], 6, []
        for n in sizes:
            parts.append(data[at:at + n])
            at += n
        self.keys, self.targets, self.before, self.final, self.offsets, self.ids = parts

    @classmethod
    def open(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, np.uint8, "r"))

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, or -1 where the lexicon lacks it."""
        n = len(words)
        if not n or not len(self.keys):
            return np.full(n, -1)
        size = np.array([len(w) for w in words])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        letters = np.frombuffer(b"".join(words), np.uint8)
        state, rank, alive = np.zeros(n, np.int64), np.zeros(n, np.int64), size > 0
        for i in range(int(size.max())):
            at = np.flatnonzero(alive & (size > i))
            if not len(at):
                break
            key = state[at] << 8 | letters[start[at] + i]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            alive[at[~ok]] = False
            at, arc = at[ok], arc[ok]
            rank[at] += self.before[arc]
            state[at] = self.targets[arc]
        return np.where(alive & (self.final[state] > 0), rank, -1)

    def output(self, rank: int) -> bytes:
        """The ids of a word as little-endian 32-bit words."""
        return self.ids[self.offsets[rank]:self.offsets[rank + 1]].astype("<u4").tobytes()
