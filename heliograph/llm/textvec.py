"""Vectorised text primitives for Arrow batches: blocks of documents, words, lines and their hashes.

A block is a run of documents joined by newlines, about BLOCK_BYTES long, so that the working
arrays stay small whatever the batch holds; one longer document is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 1))
        for k, base in enumerate((_MULTIPLIER, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(texts: list[bytes | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, data, starts) of each block: its documents, their joined bytes and where each begins.

    Every document, the last one too, is followed by a newline in data. Null counts as empty.
    """
    first, held, size = 0, [], 0
    for k, text in enumerate(texts):
        text = text or b""
        if held and size + len(text) > BLOCK_BYTES:
            yield _block(first, held)
            first, held, size = k, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield _block(first, held)


def _block(first: int, held: list[bytes]) -> tuple[int, int, np.ndarray, np.ndarray]:
    starts = np.zeros(len(held), np.int64)
    np.cumsum([len(x) + 1 for x in held[:-1]], out=starts[1:])
    return first, first + len(held), np.frombuffer(b"\n".join(held) + b"\n", np.uint8), starts


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; data ends with white space."""
    space = IS_SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes that depends on nothing around it. Spans are ascending, not empty."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * down[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive word hashes; len(words) - n + 1 of them."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(_MULTIPLIER) + words[k : k + count]
    return mix(out)


def owner(positions: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Index of the document that holds each ascending position."""
    return np.searchsorted(starts, positions, side="right") - 1
