"""A lexicon as a minimal acyclic transducer: words to token ids, suffixes shared, in one file that is memory-mapped.

Edges carry numbers whose sum along a word's path is the word's place in the lexicon, so states can be shared whatever
ids the words have; the ids stand in a table by place. Edges live in an open-addressing table, and lookups walk all
words of a batch at once, one byte a step.
"""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)
MAX_WORD_BYTES = 32


def build_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Edges and finality of the minimal automaton of distinct words in byte order; state 0 is the root."""
    edges: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]  # states of the word before

    def freeze(keep: int, word: bytes) -> None:
        """Replace the states of ``word`` beyond ``keep`` bytes by equal ones known already, from its end."""
        for depth in range(len(path) - 1, keep, -1):
            state = path[depth]
            sign = (final[state], tuple(edges[state].items()))
            same = known.setdefault(sign, state)
            if same != state:
                edges[path[depth - 1]][word[depth - 1]] = same
            path.pop()

    before = b""
    for word in words:
        common = 0
        while common < min(len(word), len(before)) and word[common] == before[common]:
            common += 1
        freeze(common, before)
        for byte in word[common:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][byte] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        before = word
    freeze(0, before)
    return edges, final


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """The lexicon file of (word, ids): header, edge keys, targets, numbers, finality, id offsets and ids, all int32."""
    entries = sorted(entries)
    edges, final = build_automaton([w for w, _ in entries])
    renumber, order, stack = {0: 0}, [0], [0]
    while stack:
        for t in edges[stack.pop()].values():
            if t not in renumber:
                renumber[t] = len(order)
                order.append(t)
                stack.append(t)
    below: dict[int, int] = {}
    todo = [(0, False)]
    while todo:
        s, ready = todo.pop()
        if ready:
            below[s] = final[s] + sum(below[t] for t in edges[s].values())
        elif s not in below:
            todo.append((s, True))
            todo.extend((t, False) for t in edges[s].values() if t not in below)
    keys, targets, numbers = [], [], []
    for s in order:
        number = int(final[s])
        for byte, t in sorted(edges[s].items()):
            keys.append(renumber[s] << 8 | byte)
            targets.append(renumber[t])
            numbers.append(number)
            number += below[t]
    size = 1 << max(4, int(np.ceil(np.log2(2.5 * max(1, len(keys))))))
    table = np.full((3, size), -1, np.int32)
    left = np.arange(len(keys))
    k, t, m = (np.array(x, np.int32) for x in (keys, targets, numbers))
    at = _slot(k, size)
    while len(left):  # every round the first claimant of each free slot gets it, the others move on
        slot, claim = np.unique(at[left], return_index=True)
        free = table[0, slot] == -1
        won = left[claim[free]]
        table[:, slot[free]] = k[won], t[won], m[won]
        left = np.setdiff1d(left, won, assume_unique=True)
        at[left] = (at[left] + 1) & (size - 1)
    finals = np.array([final[s] for s in order], np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(ids) for _, ids in entries])]).astype(np.int32)
    ids = np.array([i for _, some in entries for i in some], np.int32)
    header = np.array([size, len(finals), len(offsets), len(ids)], np.int32)
    return np.concatenate([header, table.ravel(), finals, offsets, ids]).tobytes()


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((key.astype(np.uint64) * MIX) >> np.uint64(64 - int(size).bit_length() + 1)).astype(np.int64)


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, np.int32, "r")
        size, states, words, ids = (int(x) for x in raw[:4])
        parts = np.split(raw[4:], np.cumsum([size, size, size, states, words, ids]))
        self.size, (self.keys, self.targets, self.numbers, self.final, self.offsets, self.ids) = size, (np.asarray(p) for p in parts[:6])

    def places(self, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Place of each word in the lexicon, -1 if it isn't there; words are stretches of ``data``."""
        out = np.full(len(begin), -1, np.int64)
        act = np.flatnonzero(length <= MAX_WORD_BYTES)
        state, number, at, left = np.zeros(len(act), np.int32), np.zeros(len(act), np.int32), begin[act], length[act]
        mask = self.size - 1
        while len(act):
            key = (state << 8) | data[at]
            slot = _slot(key, self.size)
            here = self.keys[slot]
            open_ = np.flatnonzero((here != key) & (here != -1))
            while len(open_):
                slot[open_] = (slot[open_] + 1) & mask
                here[open_] = self.keys[slot[open_]]
                open_ = open_[(here[open_] != key[open_]) & (here[open_] != -1)]
            hit = here == key
            slot, act, at, left = slot[hit], act[hit], at[hit] + 1, left[hit] - 1
            state, number = self.targets[slot], number[hit] + self.numbers[slot]
            done = left == 0
            if done.any():
                ok = done & (self.final[state] == 1)
                out[act[ok]] = number[ok]
                more = ~done
                act, at, left, state, number = act[more], at[more], left[more], state[more], number[more]
        return out
