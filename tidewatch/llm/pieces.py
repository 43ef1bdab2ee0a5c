"""Exact ids of a sentencepiece BPE model through the cuts no merge can cross.

The model merges two neighbours only into a piece it knows. Where the byte pair around a place
stands next to each other in no piece, no merge ever crosses that place, so the ids of a text are
the ids of its stretches between such places in a row. The table of byte pairs is read off the
model's own pieces. Stretches are short and repeat: ``Pieces`` finds them with array operations
and asks the library only for those it has not seen.
"""

import functools

import numpy as np
import pyarrow as pa

from tidewatch.llm.common import mix
from tidewatch.llm.words import powers

CACHE = 250_000
#: Stretches longer than this are encoded each time instead of remembered.
LONG = 64
_MARK = "▁"
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Pieces:
    """Cuts, ids and token lengths of one sentencepiece model that keeps all white space."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        near = np.zeros((256, 256), dtype=bool)
        self.shown: list[bytes] = []
        for k in range(size):
            piece = self.model.id_to_piece(k)
            if self.model.is_byte(k):
                self.shown.append(bytes([int(piece[3:5], 16)]))
                continue
            shown = piece.replace(_MARK, " ").encode()
            self.shown.append(shown)
            if not self.model.is_control(k) and not self.model.is_unknown(k):
                near[np.frombuffer(shown[:-1], np.uint8), np.frombuffer(shown[1:], np.uint8)] = True
        #: A character that no piece has; it keeps a stretch apart from the blank the library puts first.
        self.guard = next(chr(c) for c in (10, *range(1, 32)) if not near[c].any() and not near[:, c].any())
        self.ahead = len(self.model.encode(self.guard))
        near[:, 0x80:0xC0] = True  # no cut within a character
        self.cut = ~near.reshape(-1)
        self.sizes = np.array([len(x) for x in self.shown], dtype=np.int64)
        self.seen: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def starts(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where stretches of texts in a row begin. ``begin``: where the texts themselves begin."""
        start = np.zeros(len(data), dtype=bool)
        start[1:] = self.cut[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        start[begin] = True
        return np.flatnonzero(start)

    def ids_of(self, stretches: list[bytes]) -> list[bytes]:
        """The library's ids of stretches, as little-endian 16-bit numbers, without a blank put first."""
        found = self.model.encode([self.guard + x.decode() for x in stretches], num_threads=1)
        return [np.array(x[self.ahead:], dtype="<u2").tobytes() for x in found]

    def known(self, stretches: list[bytes]) -> list[bytes]:
        """The ids of each stretch, from the worker's cache where it has them."""
        if len(self.seen) > CACHE:
            self.seen, self.old = {}, self.seen
        out = list(map(self.seen.get, stretches))
        new = []
        for k, ids in enumerate(out):
            if ids is None:
                ids = out[k] = self.old.get(stretches[k])
                if ids is None:
                    new.append(k)
                else:
                    self.seen[stretches[k]] = ids
        for k, ids in zip(new, self.ids_of([stretches[k] for k in new]), strict=True):
            out[k] = ids
            if len(stretches[k]) <= LONG:
                self.seen[stretches[k]] = ids
        return out

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[bounds[k]:bounds[k + 1]]``, and where each text's begin.

        Texts come with the blank that the library puts first, and empty ones without it.
        """
        if not len(data):
            return np.empty(0, dtype="<u2"), np.zeros(len(bounds), dtype=np.int64)
        start = self.starts(data, bounds[:-1][bounds[:-1] < bounds[1:]])
        ends = np.append(start, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        words = words.dictionary_encode()
        known = self.known(words.dictionary.to_pylist())
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) >> 1
        flat, place = np.frombuffer(b"".join(known), dtype="<u2"), np.cumsum(size) - size
        which = words.indices.to_numpy()
        size, place = size[which], place[which]
        total = np.cumsum(size)
        ids = flat[np.repeat(place - total + size, size) + np.arange(total[-1])]
        return ids, np.append(0, total)[np.searchsorted(start, bounds)]


def hash_stretches(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches that begin at ``start``, each up to the next."""
    up, down = powers(len(data) + 1)
    upto = np.append(np.uint64(0), np.cumsum(_BYTES[data] * up[:len(data)], dtype=np.uint64))
    end = np.append(start[1:], len(data))
    return mix((upto[end] - upto[start]) * down[start])


def spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a blank before each that is not empty."""
    some = bounds[:-1] < bounds[1:]
    out = np.insert(data, bounds[:-1][some], ord(" "))
    return out, bounds + np.append(0, np.cumsum(some))


def with_mark(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The texts that hold U+2581 itself, which the library cannot tell from a blank."""
    at = np.flatnonzero(data == 0xE2)
    at = at[at + 2 < len(data)]
    at = at[(data[at + 1] == 0x96) & (data[at + 2] == 0x81)]
    return np.unique(np.searchsorted(bounds, at, side="right") - 1)


@functools.cache
def pieces(path: str) -> Pieces:
    """One instance per process and model."""
    return Pieces(path)
