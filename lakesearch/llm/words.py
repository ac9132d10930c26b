"""Hashes of the words of many texts at once, in numpy.

A word is a longest run of ASCII letters, digits and characters of other scripts, in lower
case. Its hash is a random linear form of its bytes, the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters looked at in one go.
CHUNK = 1 << 20
POSITIONS = 4096

_IN_WORD = np.zeros(256, bool)
_IN_WORD[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True
_FORM = np.random.default_rng(20_240_117).integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _chunk_hashes(texts: list[str], prefixes: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    b = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    inside = _IN_WORD[b]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    text_start = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    counts = np.diff(np.append(np.searchsorted(start, text_start), len(start)))
    if not len(start):
        return [np.empty(0, np.uint64)] * (1 + len(prefixes)), counts
    sizes = end - start
    first = np.cumsum(sizes) - sizes
    at = np.flatnonzero(inside)
    position = np.arange(len(at)) - np.repeat(first, sizes)
    value = (b[at] + np.uint64(1)) * _FORM[position & (POSITIONS - 1)]
    found = [np.add.reduceat(value, first)]
    found += [np.add.reduceat(np.where(position < p, value, np.uint64(0)), first) for p in prefixes]
    return found, counts


def _cut(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > CHUNK:
        to = text.find(" ", at + CHUNK)
        if to < 0:
            break
        yield text[at:to]
        at = to
    yield text[at:]


def word_hashes(texts: list[str], prefixes: tuple[int, ...] = ()) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all words in order, then of their first p bytes for each p, and words a text."""
    pieces = [(i, piece) for i, t in enumerate(texts) for piece in _cut(t)]
    out: list[list[np.ndarray]] = [[] for _ in range(1 + len(prefixes))]
    counts, group, chars = np.zeros(len(texts), np.int64), [], 0
    for k, (i, piece) in enumerate(pieces):
        group.append((i, piece))
        chars += len(piece)
        if chars >= CHUNK or k == len(pieces) - 1:
            found, n = _chunk_hashes([p for _, p in group], prefixes)
            for o, f in zip(out, found):
                o.append(f)
            np.add.at(counts, [j for j, _ in group], n)
            group, chars = [], 0
    return [np.concatenate(o) if o else np.empty(0, np.uint64) for o in out], counts
