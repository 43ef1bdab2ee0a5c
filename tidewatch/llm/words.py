"""Words of whole texts as 64-bit hashes, found with array operations on UTF-8 bytes.

A word is a run of ASCII letters (A-Z lowered), ASCII digits and bytes beyond ASCII. Equal words
have equal hashes; different words share one with a chance of about 2 ** -64 per pair.
"""

import functools

import numpy as np

from tidewatch.llm.common import mix

_STEP = 0x9E3779B97F4A7C15


def _letters() -> np.ndarray:
    """A lowered byte's own random number; 0 for bytes between words."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))
    keep = np.zeros(256, dtype=bool)
    keep[ord("0"):ord("9") + 1] = keep[ord("a"):ord("z") + 1] = keep[0x80:] = True
    values[~keep] = 0
    values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


LETTERS = _letters()


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    up = np.full(size, _STEP, dtype=np.uint64)
    down = np.full(size, pow(_STEP, -1, 2**64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(size - 1, 1).bit_length())


def hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[bounds[k]:bounds[k + 1]]``, and where each text's begin."""
    value = LETTERS[data]
    inside = value != 0
    before = np.append(False, inside[:-1])
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.append(inside[1:], False)
    cut = bounds[1:-1] - 1
    after[cut[cut >= 0]] = False
    end = np.flatnonzero(inside & ~after) + 1
    up, down = powers(len(data) + 1)
    upto = np.append(np.uint64(0), np.cumsum(value * up[:len(data)], dtype=np.uint64))
    return mix((upto[end] - upto[start]) * down[start]), np.searchsorted(start, bounds)


def windows(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of a text, and where each text's begin.

    A text of fewer words, but not none, is one window of all its words.
    """
    count = np.diff(at)
    many = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    begin = np.append(0, np.cumsum(many))
    first = np.repeat(at[:-1] - begin[:-1], many) + np.arange(begin[-1])
    left = np.repeat(at[1:], many) - first
    out = np.zeros(len(first), dtype=np.uint64)
    padded = np.append(words, np.zeros(size, dtype=np.uint64))
    for k in range(size):
        out = mix(out * np.uint64(_STEP) + np.where(left > k, padded[first + k], np.uint64(k + 1)))
    return out, begin
