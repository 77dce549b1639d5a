"""Encoding with the tokenizers library, each distinct stretch of text encoded once."""

import os
import re

from functools import lru_cache

import numpy as np
import pyarrow as pa

from newsloom.llm.words import eights, hash_eights, ranges, slices

#: First bytes of characters beyond ASCII that can be white space.
MAYBE_BLANK_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)
KEPT_STRETCHES = 2_000_000
#: Stretches that are encoded together; and the longest one that is.
JOINED_BYTES, LONGEST_JOINED = 1 << 13, 256
PARTS_AT_A_TIME = 4

_LETTER = np.array([chr(b).isalpha() and b < 0x80 for b in range(256)])
_SIGN = np.array([0x20 < b < 0x7F and not chr(b).isalnum() and b != 0x27 for b in range(256)])
#: Bytes that a stretch may have behind its first for being encoded together with others.
_PLAIN = np.array([0x20 < b < 0x7F or 0x80 <= b < 0xC2 or 0xC3 <= b < 0xE0 or b > 0xE3 for b in range(256)])
_TABLE_BITS = 20


def stretch_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts may be cut without changing their tokens.

    A pre-token has at most one blank, at its start, and a single line feed between
    other characters is a pre-token of its own. So a cut before such a blank, before
    such a line feed and after it never falls into a pre-token, nor does one between a
    letter and an ASCII sign other than the apostrophe. Other white space, and
    characters that may be white space, are not cut at.
    """
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[n] = False
    if n < 3:
        return np.flatnonzero(cut)
    solid = (data > 0x20) & (data < 0x7F)  # one-byte characters
    lead = (data >= 0xC3) & (data < 0xE0)  # two-byte letters and marks, no white space among them
    ends_solid = solid.copy()
    ends_solid[1:] |= lead[:-1]
    begins_solid = solid | lead
    first = np.zeros(n, bool)
    first[offsets[:-1][offsets[:-1] < n]] = True
    mid = np.flatnonzero(ends_solid[:-2] & begins_solid[2:] & ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A))) + 1
    mid = mid[~first[mid] & ~first[mid + 1]]
    cut[mid] = True
    cut[mid[data[mid] == 0x0A] + 1] = True
    letter = _LETTER[data]
    sign = _SIGN[data]
    wide = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # two-byte letters
    begins, ends = letter.copy(), letter.copy()
    begins[:-1] |= wide
    ends[1:] |= wide
    cut[1:n] |= (ends[:-1] & sign[1:]) | (sign[:-1] & begins[1:])
    return np.flatnonzero(cut[:n])


class StretchEncoder:
    """Token ids of texts; remembers the ids of stretches, up to a fixed number."""

    #: Stretches remembered at most.
    most = KEPT_STRETCHES
    #: The id of a line feed, or -1 if it may be joined with others.
    line_id = -1

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int32)
        self.length = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        # The bytes behind a key: their number, and where they stand, eight to a number.
        self.sizes = np.zeros(0, np.int32)
        self.spelt_at = np.zeros(0, np.int32)
        self.spelt = np.zeros(0, np.uint64)
        # Where a key's high bits lead, for a first look; keys that share a cell replace each other.
        self.cells = np.zeros(1 << _TABLE_BITS, np.int64)
        # The first keys in order; later ones are few and are ordered on each use.
        self.order = np.zeros(0, np.int64)
        self.ranked = np.zeros(0, np.uint64)

    def prepare(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return data, offsets

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where stretches begin; every text begins one."""
        raise NotImplementedError

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _stretches(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids and each stretch's number of ids.

        Plain stretches are joined by line feeds, which are tokens of their own there.
        """
        odd = np.concatenate([[0], np.cumsum(~_PLAIN[data])])
        plain = (odd[ends] == odd[np.minimum(starts + 1, ends)]) & (ends - starts <= LONGEST_JOINED)
        plain &= self.line_id >= 0
        plain &= _PLAIN[data[starts]] | (data[starts] == 0x20) & (ends - starts > 1)
        length = np.zeros(len(starts), np.int64)
        ids = []
        joined = np.flatnonzero(plain)
        if len(joined):
            a, size = starts[joined], ends[joined] - starts[joined] + 1
            upto = np.cumsum(size)
            text = np.full(int(upto[-1]), 0x0A, np.uint8)
            inside = np.ones(len(text), bool)
            inside[upto - 1] = False
            text[inside] = data[ranges(a, size - 1)]
            cuts = np.unique(np.searchsorted(upto, np.arange(JOINED_BYTES, upto[-1] + JOINED_BYTES, JOINED_BYTES)))
            bounds = [0, *upto[np.minimum(cuts, len(upto) - 1)].tolist()]
            parts = [text[x:y].tobytes().decode() for x, y in zip(bounds[:-1], bounds[1:]) if y > x]
            # A few at a time: what the library returns for a text is many times its size.
            found = np.concatenate(
                [
                    np.array(x, np.uint32)
                    for k in range(0, len(parts), PARTS_AT_A_TIME)
                    for x in self.encode_texts(parts[k : k + PARTS_AT_A_TIME])
                ]
            )
            lines = np.flatnonzero(found == self.line_id)
            if len(lines) != len(joined):
                raise RuntimeError("a line feed is not a token of its own in this model")
            length[joined] = np.diff(lines, prepend=-1) - 1
            ids.append(found[found != self.line_id])
        single = np.flatnonzero(~plain)
        if len(single):
            found = self.encode_texts([data[x:y].tobytes().decode() for x, y in zip(starts[single], ends[single])])
            length[single] = [len(x) for x in found]
            ids += [np.array(x, np.uint32) for x in found]
        order = np.concatenate([joined, single])
        at = np.empty(len(starts), np.int64)
        at[order] = np.cumsum(length[order]) - length[order]
        all_ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        return all_ids[ranges(at, length)], length

    def _remembers(self, place: np.ndarray, sizes: np.ndarray, values: np.ndarray, counts: np.ndarray) -> bool:
        """Whether the stretches are, byte by byte, the remembered ones at their places."""
        if not (self.sizes[place] == sizes).all():
            return False
        return bool((self.spelt[ranges(self.spelt_at[place], counts)] == values).all())

    def _place(
        self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray, counts: np.ndarray
    ) -> np.ndarray:
        """Where the stretches stand in the memory; unknown ones are learnt."""
        cell = (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        place = self.cells[cell]
        if len(self.keys):
            missed = np.flatnonzero(self.keys[place] != hashes)
        else:
            missed = np.arange(len(hashes))
        if not len(missed):
            return place
        keys, first, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most and len(self.keys):
            self.forget()
            return self._place(hashes, data, starts, ends, values, counts)
        found = np.full(len(keys), -1)
        if len(self.keys) - len(self.order) > max(50_000, len(self.order) // 3):
            self.order = np.argsort(self.keys)
            self.ranked = self.keys[self.order]
        done = len(self.order)
        late = done + np.argsort(self.keys[done:])
        for order, ranked in ((self.order, self.ranked), (late, self.keys[late])):
            if len(order):
                rank = np.minimum(np.searchsorted(ranked, keys), len(order) - 1)
                hit = ranked[rank] == keys
                found[hit] = order[rank[hit]]
        new = np.flatnonzero(found < 0)
        if len(new):
            at = missed[first[new]]
            ids, length = self._stretches(data, starts[at], ends[at])
            found[new] = len(self.keys) + np.arange(len(new))
            self.at = np.concatenate([self.at, (len(self.ids) + np.cumsum(length) - length).astype(np.int32)])
            self.ids = np.concatenate([self.ids, ids])
            self.keys = np.concatenate([self.keys, keys[new]])
            self.length = np.concatenate([self.length, length.astype(np.int32)])
            upto = np.cumsum(counts)
            own = counts[at]
            self.spelt_at = np.concatenate([self.spelt_at, (len(self.spelt) + np.cumsum(own) - own).astype(np.int32)])
            self.spelt = np.concatenate([self.spelt, values[ranges(upto[at] - own, own)]])
            self.sizes = np.concatenate([self.sizes, (ends[at] - starts[at]).astype(np.int32)])
        self.cells[(keys >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = found
        place[missed] = found[which]
        return place

    def encode(self, texts: pa.Array, end: int | None = None):
        """(first row, ids, ids of each row) of slices; ``end``, if given, is put after each row's ids."""
        for row, data, offsets in slices(texts):
            data, offsets = self.prepare(data, offsets)
            starts = self.starts(data, offsets)
            ends = np.append(starts[1:], len(data))[: len(starts)]
            values, counts = eights(data, starts, ends)
            sizes = ends - starts
            place = self._place(hash_eights(values, counts, sizes), data, starts, ends, values, counts)
            if self._remembers(place, sizes, values, counts):
                length = self.length[place].astype(np.int64)
                out = self.ids[ranges(self.at[place], length)]
            else:
                # Two stretches with one hash: this slice does without the memory.
                out, length = self._stretches(data, starts, ends)
            sums = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
            upto = sums[np.searchsorted(starts, offsets)]
            if end is None:
                yield row, out, np.diff(upto)
            else:
                yield row, np.insert(out, upto[1:], np.uint32(end)), np.diff(upto) + 1


class WordEncoder(StretchEncoder):
    """A byte-level BPE model file of the tokenizers library.

    With ``specials`` special tokens that stand in a text are tokens, as the library has
    it unless told otherwise; else they are spelled out.
    """

    def __init__(self, path: str, specials: bool = False):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Each stretch is encoded once, so the library's own memory of words is no use here.
        getattr(self.tokenizer.model, "_resize_cache", int)(0)
        self.tokenizer.encode_special_tokens = not specials
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if t.content and (specials or not t.special)]
        contents = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, contents))) if contents else None
        # Tokens that look at what is around them, or are found in altered text: no cut at all.
        self.whole = any(t.lstrip or t.rstrip or t.single_word or len(t.content.split()) != 1 for t in added)
        self.altered = self.tokenizer.normalizer is not None and any(t.normalized for t in added)
        # Such a token could take the line feeds that would join it with others.
        self.line_id = -1 if self.whole or self.altered else self.encode_texts(["\n"])[0][0]

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts = stretch_starts(data, offsets)
        if self.added is None:
            return starts
        text = data.tobytes()
        if not self.altered and not self.added.search(text):
            return starts
        cut = np.zeros(len(data) + 1, bool)
        cut[starts] = True
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            for m in self.added.finditer(text, a, b):
                if self.whole:
                    break
                # The library looks for added tokens first, and splits what is between them.
                cut[m.start() : m.end()] = False
                cut[[m.start(), m.end()]] = True
            if self.altered or self.whole and self.added.search(text, a, b):
                cut[a + 1 : b] = False
        return np.flatnonzero(cut[: len(data)])

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        # Without offsets, which nobody asks for.
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=1)
def word_encoder(path: str, specials: bool = False) -> WordEncoder:
    """One for each Python worker, so that its tasks share what it has learnt."""
    return WordEncoder(path, specials)
