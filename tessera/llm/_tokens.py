"""Tokenisation with the tokenizers library at a price paid once a word instead of once an occurrence.

Both vocabularies split a text into pieces by a fixed pattern and encode each piece alone. Pieces are found on whole
arrays of characters, found in a store by 64-bit hashes and compared with what it holds byte for byte, and only pieces
not met before go through the library. This holds for texts of plain Latin-1 characters; any other text, and any text that may hold a special token, goes through the
library as it is.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from tokenizers import Tokenizer

from ._common import Bytes, ragged

#: Pieces, and bytes of them, kept between batches; beyond either the store is emptied. Bounds a worker's memory.
MOST_PIECES, MOST_BYTES = 1 << 20, 1 << 25

LETTER, NUMBER, SPACE, OTHER, UNSAFE = range(5)
KIND = np.full(256, UNSAFE, np.uint8)
KIND[33:127] = OTHER
KIND[48:58] = NUMBER
KIND[65:91] = KIND[97:123] = KIND[192:256] = LETTER
KIND[[161, 162, 163, 164, 165, 166, 167, 168, 169, 171, 172, 174, 175, 176, 177, 180, 182, 183, 184, 187, 191, 215, 247]] = OTHER
KIND[[9, 10, 13, 32]] = SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[192:223] += 32
LOWER[215] = 215
APOSTROPHE, BLANK = 39, 32
#: Byte-level vocabularies write a byte as its own character if that is visible, else as the next one from U+0100 on.
VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_NAMES = {b: b if b in VISIBLE else 256 + sum(x not in VISIBLE for x in range(b)) for b in range(256)}


class Encoder:
    """One vocabulary. spaced: a blank belongs to the piece after it; otherwise white space is dropped, letters lower-cased, digits parted."""

    def __init__(self, path: str, spaced: bool):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.spaced = spaced
        self.reset()

    def reset(self) -> None:
        self.keys, self.slots = np.zeros(1 << 18, np.uint64), np.zeros(1 << 18, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.at, self.size, self.pieces = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0
        self.raw, self.raw_at, self.raw_used = Bytes(np.zeros(1 << 18, np.uint8)), np.zeros((2, 1 << 14), np.int64), 0
        self.others: dict[bytes, int] = {}

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the store by open addressing, all hashes at once; -1 where unknown."""
        mask = np.uint64(len(self.keys) - 1)
        slot = hashes & mask
        found = self.keys[slot]
        out = np.where(found == hashes, self.slots[slot], -1)
        left = np.flatnonzero((found != hashes) & (found != 0))
        while len(left):
            slot[left] = (slot[left] + np.uint64(1)) & mask
            found = self.keys[slot[left]]
            hit = found == hashes[left]
            out[left[hit]] = self.slots[slot[left[hit]]]
            left = left[~hit & (found != 0)]
        return out

    def insert(self, hashes: np.ndarray, place: np.ndarray) -> None:
        """Enters hashes that differ from each other and from all known ones."""
        mask = np.uint64(len(self.keys) - 1)
        slot = hashes & mask
        left = np.arange(len(hashes))
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = hashes[free]  # of those that want one slot the last one gets it
            self.slots[slot[free]] = place[free]
            left = left[self.keys[slot[left]] != hashes[left]]
            slot[left] = (slot[left] + np.uint64(1)) & mask

    def store(self, words: list[bytes], hashes: np.ndarray | None) -> np.ndarray:
        """Encodes pieces and keeps their ids and bytes; entered by hash where one is given."""
        ids, sizes = self.learn(words)
        lengths = np.array([len(w) for w in words], np.int64)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.pieces + len(sizes) > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size))
            self.raw_at = np.concatenate([self.raw_at, np.zeros_like(self.raw_at)], axis=1)
        total = int(lengths.sum())
        if self.raw_used + total > len(self.raw.data) - 8:
            grown = Bytes(np.zeros(2 * (self.raw_used + total), np.uint8))
            grown.data[: self.raw_used] = self.raw.data[: self.raw_used]
            self.raw = grown
        place = np.arange(self.pieces, self.pieces + len(sizes))
        self.flat[self.used : self.used + len(ids)] = ids
        self.at[place], self.size[place] = self.used + np.cumsum(sizes) - sizes, sizes
        self.raw.data[self.raw_used : self.raw_used + total] = np.frombuffer(b"".join(words), np.uint8)
        self.raw_at[:, place] = self.raw_used + np.cumsum(lengths) - lengths, lengths
        self.used, self.raw_used, self.pieces = self.used + len(ids), self.raw_used + total, self.pieces + len(sizes)
        if 2 * self.pieces > len(self.keys):
            known = self.keys != 0
            keys, slots = self.keys[known], self.slots[known]
            size = 1 << (2 * self.pieces).bit_length()
            self.keys, self.slots = np.zeros(size, np.uint64), np.zeros(size, np.int64)
            self.insert(keys, slots)
        if hashes is not None:
            self.insert(hashes, place)
        return place

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of many pieces, one after another, and how many each has."""
        merge = self.library.model.tokenize
        # all at once, parted by byte 0, which no safe text holds
        names = b"\0".join(words).decode("latin-1").encode().decode("latin-1").translate(BYTE_NAMES).split(chr(BYTE_NAMES[0])) if words else []
        found = [[t.id for t in merge(w)] for w in names]
        sizes = np.array([len(x) for x in found], np.int64)
        return np.fromiter((i for x in found for i in x), np.int32, int(sizes.sum())), sizes

    def places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where in the store each piece is; unknown pieces are encoded first."""
        if self.pieces > MOST_PIECES or self.raw_used > MOST_BYTES:
            self.reset()
        texts, lengths = Bytes(data), ends - starts
        hashes = texts.hashes(starts, lengths) | np.uint64(1)
        place = self.look_up(hashes)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new, first, inverse = np.unique(hashes[missing], return_index=True, return_inverse=True)
            raw, first = data.tobytes(), missing[first]
            place[missing] = self.store([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], new)[inverse]
        there, known = self.raw_at[:, place]
        equal = (known == lengths) & texts.same(starts, self.raw, there, np.minimum(known, lengths))
        for i in np.flatnonzero(~equal).tolist():  # a piece that shares its hash with another one
            if (content := data[starts[i] : ends[i]].tobytes()) not in self.others:
                self.others[content] = int(self.store([content], None)[0])
            place[i] = self.others[content]
        return place

    def split(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of many texts that stand one after another; edges: where each begins, and the end."""
        n = len(data)
        kind = KIND[data]
        edge = np.zeros(n + 1, bool)
        edge[edges] = True
        first = np.ones(n, bool)
        first[1:] = (kind[1:] != kind[:-1]) | edge[1:n]
        if not self.spaced:
            first |= kind == NUMBER
        run = np.flatnonzero(first)
        end = np.r_[run[1:], n]
        kinds = kind[run]
        # a lone apostrophe and the letters after it
        after = np.r_[(kinds[1:] == LETTER) & ~edge[run[1:]], False] if len(run) else np.zeros(0, bool)
        lone = (kinds == OTHER) & (end - run == 1) & (data[run] == APOSTROPHE) & after
        blank_before = np.zeros(len(run), bool)
        inner = (run > 0) & ~edge[run]
        blank_before[inner] = data[run[inner] - 1] == BLANK
        if self.spaced:
            lone &= ~blank_before
        at = np.flatnonzero(lone)
        begin, stop = run.copy(), end.copy()
        cut = np.zeros(0, np.int64)
        if len(at):
            c1, room = data[run[at] + 1], end[at + 1] - run[at + 1]
            c2 = data[np.minimum(run[at] + 2, n - 1)]
            is_ = lambda c, x: c == ord(x)
            pair = (room >= 2) & ((is_(c1, "r") & is_(c2, "e")) | (is_(c1, "v") & is_(c2, "e")) | (is_(c1, "l") & is_(c2, "l")))
            one = is_(c1, "s") | is_(c1, "t") | is_(c1, "m") | is_(c1, "d")
            take = np.where(one, 1, np.where(pair, 2, 0))
            at, take = at[take > 0], take[take > 0]
            stop[at] = run[at] + 1 + take
            begin[at + 1] = stop[at]
            cut = at + 1
        if not self.spaced:
            keep = (kinds != SPACE) & (begin < stop)
            return begin[keep], stop[keep]
        space = kinds == SPACE
        follows = np.r_[~edge[run[1:]], False] if len(run) else np.zeros(0, bool)
        joined = space & follows & (data[end - 1] == BLANK)
        parted = space & follows & ~joined & (end - run >= 2)
        takes = ~space & blank_before
        takes[cut] = False
        starts = np.concatenate([(begin - takes)[~space & (begin < stop)], run[space & ~(joined & (end - run == 1))], end[parted] - 1])
        starts.sort()
        ends = np.r_[starts[1:], n]
        return starts, ends

    def safe(self, text: str) -> bytes | None:
        """The characters of a text that the fast way may take, one byte each."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if "<|" in text or (KIND[np.frombuffer(raw, np.uint8)] == UNSAFE).any():
            return None
        return raw

    def batch(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Many safe texts: the pieces' starts (in all texts together), their places in the store, and the texts' edges in pieces."""
        edges = np.r_[0, np.cumsum([len(r) for r in raws])].astype(np.int64)
        data = np.frombuffer(b"".join(raws), np.uint8)
        if not self.spaced:
            data = LOWER[data]
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(raws) + 1, np.int64)
        starts, ends = self.split(data, edges)
        return starts, self.places(data, starts, ends), np.searchsorted(starts, edges)

    def ids(self, raws: list[bytes]) -> list[np.ndarray]:
        """The token ids of each safe text."""
        _, place, edges = self.batch(raws)
        sizes = self.size[place]
        flat = self.flat[ragged(self.at[place], sizes)]
        bounds = np.r_[0, np.cumsum(sizes)][edges]
        return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def slow_ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)

    def slow_starts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Token starts that follow white space, and the tokens from each to the next."""
        encoded = self.library.encode(text, add_special_tokens=False)
        starts = np.array([a for a, _ in encoded.offsets], np.int64)
        firm = np.array([i == 0 or (a > 0 and a != starts[i - 1] and text[a - 1].isspace() and not unicodedata.combining(text[a])) for i, a in enumerate(starts.tolist())], bool)
        at = np.flatnonzero(firm)
        return starts[at], np.diff(np.r_[at, len(starts)])


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(name: str, spaced: bool) -> Encoder:
    """This process's encoder of one public vocabulary (its pieces outlive a task)."""
    import public_tokenizers

    key = name, spaced
    if key not in _encoders:
        _encoders[key] = Encoder(public_tokenizers.path(name), spaced)
    return _encoders[key]
