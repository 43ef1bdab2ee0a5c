"""Exact token ids of whole texts through a word cache over a public tokenizer.

A byte-pair tokenizer cuts a text into words before it merges bytes, and no merge crosses a word.
The ids of a text are therefore the ids of its words in a row, and a corpus repeats its words.
``Encoder`` finds the words of a batch of texts with array operations, lets Arrow number the
distinct ones, asks the tokenizers library only for words it has not seen, and puts the ids
together again. Runs of other characters than plain letters, digits and signs go to the library
as they stand between white space, and texts with unusual white space or with an added token such
as <|endoftext|> go there whole, so the ids always equal the library's. The cache is bounded: a full one becomes the old generation, from
which words still in use move over.
"""

import functools
import json
import re

import numpy as np
import pyarrow as pa

CACHE = 600_000
BATCH_BYTES = 8 << 20
LETTER, DIGIT, SIGN, BLANK, BREAK, OTHER = range(6)
_OTHER = re.compile(rb"'|[\x80-\xc2\xc4-\xff](?<!\xc3.)|\xc3[\x97\xb7]", re.DOTALL)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, dtype=np.uint8)
    kinds[:128] = SIGN
    for low, high, kind in ((b"A", b"Z", LETTER), (b"a", b"z", LETTER), (b"0", b"9", DIGIT), (b"\t", b"\r", BREAK)):
        kinds[low[0]:high[0] + 1] = kind
    kinds[ord(" ")], kinds[ord("'")] = BLANK, OTHER
    return kinds


KINDS = _byte_kinds()


def _byte_letters() -> list[str]:
    """The printable letter that byte-level tokenizers use for each byte."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = (chr(256 + k) for k in range(256))
    return [chr(b) if b in own else next(rest) for b in range(256)]


class Encoder:
    """``encode(texts)``: ids of an Arrow array of texts and where each text's ids begin."""

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain  # their strings are then text like any other
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        #: What the library cuts out before words; folded, as a tokenizer may look in the folded text.
        self.added = [] if plain else sorted({t["content"].encode().lower() for t in spec["added_tokens"]})
        norm, pre = spec["normalizer"] or {}, spec["pre_tokenizer"] or {}
        steps = [x["type"] for x in norm.get("normalizers", [])]
        cuts = [x["type"] for x in pre.get("pretokenizers", [])]
        #: Words keep the blank before them; or blanks go, letters become small, digits stand alone.
        self.spaced = not norm and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        self.lowered = (steps == ["NFC", "Replace", "Lowercase"] and cuts == ["Split", "ByteLevel"]
                        and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in pre["pretokenizers"][0]["pattern"].get("Regex", ""))
        self.letters = dict(enumerate(_byte_letters()))
        self.seen: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        """The library's own ids."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn(self, words: list[bytes]) -> None:
        """Remember the ids of words not seen before."""
        plain = []
        for word in words:
            if b"'" in word or not word.isascii() and _OTHER.search(word):
                self.seen[word] = self.whole(word.decode()).tobytes()
            elif self.lowered and word.isspace():
                self.seen[word] = b""
            else:
                plain.append(word)
        if not plain:
            return
        ids, upto, tokenize = [], [0], self.model.tokenize
        # No UTF-8 text has the byte 0xff, so its letter can stand between words.
        for shown in b"\xff".join(plain).decode("latin-1").translate(self.letters).split(self.letters[255]):
            ids += [t.id for t in tokenize(shown)]
            upto.append(4 * len(ids))
        raw = np.array(ids, dtype="<u4").tobytes()
        self.seen.update(zip(plain, map(raw.__getitem__, map(slice, upto[:-1], upto[1:])), strict=True))

    def _known(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        if len(self.seen) > CACHE:
            self.seen, self.old = {}, self.seen
        out, old = list(map(self.seen.get, words)), self.old
        new = [k for k, ids in enumerate(out) if ids is None]
        kept = {words[k]: old[words[k]] for k in new if words[k] in old}
        self.seen.update(kept)
        self._learn([words[k] for k in new if words[k] not in kept])
        for k in new:
            out[k] = self.seen[words[k]]
        return out

    def _starts(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Where words start. ``begin``: whether a text begins at the byte."""
        kind = KINDS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # À to ÿ, without the two signs among them
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = LETTER
        kind[lead + 1] = LETTER
        after, ahead = np.empty_like(kind), np.empty_like(kind)
        after[0], after[1:] = BREAK, kind[:-1]
        ahead[-1], ahead[:-1] = BREAK, kind[1:]
        white, was_white = (kind == BLANK) | (kind == BREAK), (after == BLANK) | (after == BREAK)
        if self.lowered:
            start = (kind != after) | (kind == DIGIT)
            small = (data >= ord("A")) & (data <= ord("Z"))
            capital = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] <= 0x9E)] + 1
        else:
            last = np.empty_like(begin)  # the next byte is another text's, or none
            last[-1], last[:-1] = True, begin[1:]
            start = np.where(white, ~was_white | ~((ahead == BLANK) | (ahead == BREAK) | last),
                             (kind != after) & (after != BLANK))
        odd = np.flatnonzero(kind == OTHER)
        if len(odd):  # no cut within a run of non-blanks that has such a character
            edge = np.flatnonzero((white != was_white) | begin)
            run = np.searchsorted(edge, odd, side="right") - 1
            run = np.unique(run)
            low, high = edge[run], np.append(edge, len(data))[run + 1]
            inside = np.zeros(len(data) + 1, dtype=np.int8)
            inside[low] += 1
            inside[high] -= 1
            inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
            first = np.zeros(len(data), dtype=bool)
            first[low] = start[low]
            start = np.where(inside, first, start)
            if self.lowered:
                small &= ~inside
                capital = capital[~inside[capital]]
        if self.lowered:
            data[small] += 32
            data[capital] += 32
        return start | begin

    def _odd_spaces(self, data: np.ndarray) -> np.ndarray:
        """Bytes at which white space beyond ASCII begins."""
        at = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
        at = at[at + 1 < len(data)]
        one, two, three = data[at], data[at + 1], data[np.minimum(at + 2, len(data) - 1)]
        return at[((one == 0xC2) & ((two == 0x85) | (two == 0xA0))) | ((one == 0xE1) & (two == 0x9A))
                  | ((one == 0xE2) & (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)))
                  | ((one == 0xE2) & (two == 0x81) & (three == 0x9F)) | ((one == 0xE3) & (two == 0x80))]

    def _with_added(self, data: np.ndarray, bounds: np.ndarray) -> list[int]:
        """The texts that may hold an added token; one search resumes behind each text found."""
        folded, out = data.tobytes().lower(), []
        for token in self.added:
            at = folded.find(token)
            while at >= 0:
                out.append(int(np.searchsorted(bounds, at, side="right")) - 1)
                at = folded.find(token, int(bounds[out[-1] + 1]))
        return out

    def _block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[bounds[k]:bounds[k + 1]]``, and how many each has."""
        counts = np.zeros(len(bounds) - 1, dtype=np.int64)
        if not len(data):
            return np.empty(0, dtype="<u4"), counts
        if not (self.spaced or self.lowered):
            parts = [self.whole(bytes(data[a:b]).decode()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            return np.concatenate(parts), np.array([len(x) for x in parts])
        odd = np.searchsorted(bounds, self._odd_spaces(data), side="right") - 1
        odd = np.union1d(odd, np.array(self._with_added(data, bounds), dtype=odd.dtype))
        raw ={int(k): bytes(data[bounds[k]:bounds[k + 1]]).decode() for k in odd}
        data = data.copy()
        begin = np.zeros(len(data), dtype=bool)
        begin[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        start = np.flatnonzero(self._starts(data, begin))
        ends = np.append(start, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        words = words.dictionary_encode()
        known = self._known(words.dictionary.to_pylist())
        size = np.fromiter(map(len, known), dtype=np.int32, count=len(known)) >> 2
        flat, place = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(size, dtype=np.int32) - size
        which = words.indices.to_numpy()
        size, place = size[which], place[which]
        total = np.cumsum(size, dtype=np.int32)
        ids = flat[np.repeat(place - total + size, size) + np.arange(total[-1], dtype=np.int32)]
        upto = np.append(0, total)[np.searchsorted(start, bounds)]
        counts = np.diff(upto)
        if raw:
            parts = np.split(ids, upto[1:-1])
            for k, text in raw.items():
                parts[k] = self.whole(text)
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts])
        return ids, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) in a row, and the offsets at which each text's begin."""
        texts = texts.fill_null("").cast(pa.large_string())
        if not len(texts):
            return np.empty(0, dtype="<u4"), np.zeros(1, dtype=np.int64)
        _, where, buffer = texts.buffers()
        bounds = np.frombuffer(where, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.empty(0, dtype=np.uint8)
        ids, counts, low = [], [], 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + BATCH_BYTES, side="right")) - 1)
            part = self._block(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low])
            ids.append(part[0])
            counts.append(part[1])
            low = high
        return np.concatenate(ids), np.append(0, np.cumsum(np.concatenate(counts)))


@functools.cache
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per process and tokenizer; a ``plain`` one takes special tokens' strings for text."""
    return Encoder(path, plain)


def token_bytes(path: str) -> list[bytes]:
    """What each entry of a byte-level tokenizer stands for, by id."""
    from tokenizers import Tokenizer

    back = {letter: byte for byte, letter in enumerate(_byte_letters())}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for entry, k in vocabulary.items():
        out[k] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
    return out


def public_path(name: str) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)
