"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Word: a run of bytes other than ASCII white space (0x20, 0x09 to 0x0D) in the UTF-8 text,
which is what ``bytes.split`` finds. Lower case changes A-Z only, which is what ``bytes.lower`` does.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

STEP_BYTES, STEP_TEXTS = 512 << 10, 4096  # texts worked on together, few enough for the caches

_MUL1, _MUL2, _MUL3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer: 64 bits to 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MUL2
    x = (x ^ (x >> np.uint64(27))) * _MUL3
    return x ^ (x >> np.uint64(31))


def utf8(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 bytes; NULL counts as empty. Lone surrogates, which UTF-8 has no form for, become '?'."""
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


def steps(items: list[bytes], size: int = STEP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts with about ``size`` bytes, and the place of their first."""
    first, held = 0, 0
    for i, item in enumerate(items):
        held += len(item) + 1
        if held >= size or i + 1 - first >= STEP_TEXTS:
            yield first, items[first : i + 1]
            first, held = i + 1, 0
    if first < len(items):
        yield first, items[first:]


class Words:
    """Hashes of all words of some texts, in order.

    ``hashes[bounds[i]:bounds[i + 1]]`` are the words of text ``i``; ``starts`` and
    ``ends`` are their places in ``buffer``.
    """

    def __init__(self, texts: list[bytes]) -> None:
        joined = b" ".join(texts)
        self.size = len(joined)
        data = np.frombuffer(joined + b" " * 16, dtype=np.uint8)
        space = _SPACE[data[: self.size + 1]]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.buffer, self.starts, self.ends = data, edge[0::2], edge[1::2]
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.bounds = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        # every place as the eight bytes that begin there
        eight = np.ndarray(shape=(self.size + 8,), dtype="<u8", buffer=self.buffer, strides=(1,))
        length = self.ends - self.starts
        out = mix(length.astype(np.uint64) * _MUL1 + _MUL3)
        todo, at = np.arange(len(length)), 0
        while len(todo):
            left = length[todo] - at
            piece = eight[self.starts[todo] + at] & _KEEP[np.minimum(left, 8)]
            out[todo] = mix((out[todo] ^ piece) * _MUL1 + _MUL2)
            at += 8
            todo = todo[left > 8]
        return out

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def owners(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, bounds)`` of the distinct ``size``-word shingles of every text, sorted in each.

    A text with fewer words has its whole sequence as the only one; without words it has none.
    """
    n = len(words.hashes)
    counts = np.diff(words.bounds)
    chain = words.hashes.copy()
    for j in range(1, min(size, n)):
        chain[: n - j] = mix(chain[: n - j] * _MUL1 + words.hashes[j:] * _MUL3 + np.uint64(j))
    # the shingle at a word is whole if the text has enough words from there on
    owners = words.owners()
    whole = np.arange(n) + size <= words.bounds[1:][owners]
    hashes, owner = chain[whole], owners[whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for k, i in enumerate(short):
            value = words.hashes[words.bounds[i]]
            for w in words.hashes[words.bounds[i] + 1 : words.bounds[i + 1]]:
                value = mix(np.array([value]) * _MUL1 + np.array([w]) * _MUL2 + np.uint64(size))[0]
            extra[k] = mix(np.array([value ^ _MUL3]))[0]
        hashes, owner = np.concatenate([hashes, extra]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        fresh = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
        hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(words) + 1))
