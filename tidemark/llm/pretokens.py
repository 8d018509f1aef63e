"""Splitting of texts into the words of a byte-level BPE, vectorised over whole batches.

The pattern is  's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+  and its matches follow from
runs of characters of one class: a blank before a run joins it, the rest of a stretch of white space stands alone.
"""

from __future__ import annotations

import numpy as np

OTHER, LETTER, DIGIT, SPACE = 0, 1, 2, 3
BLANK, APOSTROPHE = 32, 39


def character_classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    at = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\p{White_Space}+", SPACE)):
        for m in regex.finditer(pattern, every):
            table[at[m.start() : m.end()]] = kind
    return table


def word_starts(cp: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Index of the first character of each word of texts laid end to end; ``first`` holds where each text begins."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[cp]
    begins = np.zeros(n, bool)
    begins[first[first < n]] = True
    run = begins.copy()
    run[0] = True
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # The last white-space character before other text is a word's blank, or else stands alone.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:])
    start[last] = True
    start[last[cp[last] == BLANK] + 1] = False
    # A lone apostrophe that opens a word may open a contraction, which ends inside the letters after it.
    lone = np.flatnonzero((cp == APOSTROPHE) & run & start)
    lone = lone[lone + 1 < n]
    lone = lone[(kind[lone + 1] == LETTER) & ~begins[lone + 1]]
    if len(lone):
        one = cp[lone + 1]
        two = np.where((lone + 2 < n) & ~begins[np.minimum(lone + 2, n - 1)], cp[np.minimum(lone + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        hit = short | long
        start[lone[hit] + 1] = False
        rest = lone[hit] + np.where(short[hit], 2, 3)
        rest = rest[rest < n]
        start[rest[(kind[rest] == LETTER) & ~run[rest]]] = True
    return np.flatnonzero(start)


def lay_out(data: bytes, ends: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of texts laid end to end as UTF-8: (first byte, length in bytes, words per text); ``ends`` in bytes."""
    cp = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    byte_at = np.concatenate([[0], np.cumsum(width)])
    begins = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(byte_at, begins)
    starts = word_starts(cp, first[ends > begins], classes)
    begin = byte_at[starts]
    per_text = np.searchsorted(begin, ends) - np.searchsorted(begin, begins)
    return begin, np.diff(np.append(begin, len(data))), per_text


def slices(texts, most_bytes: int = 2_000_000):
    """Cut an Arrow string array without nulls into (data, ends) of about ``most_bytes``; one longer text stands alone."""
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = memoryview(body) if body is not None else memoryview(b"")
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most_bytes, "right")) - 1)
        yield bytes(data[offsets[i] : offsets[j]]), offsets[i + 1 : j + 1] - offsets[i]
        i = j
