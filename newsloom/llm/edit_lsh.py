"""Finding items in long word sequences within an edit distance; a helper of `decontamination`.

The CGK embedding reads a sequence with a walk: at step j it notes the word it stands on
and moves on by one or not at all, as a random bit of (j, word) says. Two sequences a few
edits apart fall into step again after each edit, so that the walks agree at most steps:
edit distance becomes Hamming distance. A set of sampled steps is one LSH key.

All windows of a text are walked at once. Walks that stand on the same word at the same
step stay together for good, so that the work falls with the root of the step.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from newsloom.llm.words import mix, ranges

SAMPLES = 3
SETS_PER_WALK = 6
#: Trial edits of each item, and of each size band at least.
TRIALS, BAND_TRIALS = 3, 300
#: Walks in a row that bring up no further trial of a band, after which it is given up with an error.
IDLE_WALKS = 64
BAND_RATIO = 1.5
LEAST_WORDS = 5
_LOW = np.uint64(0xFFFF)


def band_of(words: int) -> int:
    """Number of the size band; windows of a band are as long as its shortest items."""
    return int(np.log(words / LEAST_WORDS) / np.log(BAND_RATIO) + 1e-9)


def band_steps(band: int) -> int:
    """Steps that a walk takes before it may leave an item of the band."""
    return max(SAMPLES, int(1.5 * LEAST_WORDS * BAND_RATIO**band))


def _bits(words: np.ndarray, walk: int, block: int) -> np.ndarray:
    """64 steps' bits for each word."""
    return mix(words ^ mix(np.array([walk * 1_000_003 + block + 1], np.uint64)))


def _join(key: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(key * np.uint64(0x9E3779B97F4A7C15) + words)


@dataclass
class _Set:
    steps: tuple[int, ...]
    tables: list[np.ndarray]  # which low bits of the key so far any item has
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray  # where the item's walk stands at the first step


class Index:
    """LSH of items (arrays of word hashes); ``share`` of an item's words may be edited.

    Each size band gets walks until ``target`` of its own trials are found: items edited
    as much as allowed, at a start from which `decontamination` can verify them.
    ``recalls`` has the measured share of each band, ``recall`` the lowest. A band that
    stays below the target raises RuntimeError.
    """

    def __init__(self, items: list[np.ndarray], share: float, target: float, seed: int = 1):
        self.items = items
        self.edits = [int(share * len(x)) for x in items]
        self.walks: list[list[_Set]] = []
        members = [i for i, x in enumerate(items) if len(x) >= LEAST_WORDS]
        self.bands: dict[int, list[int]] = {}
        for i in members:
            self.bands.setdefault(band_of(len(items[i])), []).append(i)
        random = np.random.default_rng(seed)
        self.recalls = dict.fromkeys(sorted(self.bands), 0.0)
        trials = {}
        for band, own in self.bands.items():
            tried = own * max(TRIALS, -(-BAND_TRIALS // len(own)))
            trials[band] = (np.array(tried), *self._trial(tried, random))
        total = {band: len(t[0]) for band, t in trials.items()}
        edits, idle = np.array(self.edits), dict.fromkeys(self.bands, 0)
        while missing := [x for x, recall in self.recalls.items() if recall < target]:
            self._add_walk(random, missing)
            for band in missing:
                tried, text, starts = trials[band]
                found = np.zeros(len(tried), bool)
                for item, start in self._by_walk(text, len(self.walks) - 1):
                    # The trial that stands there or begins next.
                    for step in (-1, 0):
                        k = np.clip(np.searchsorted(starts, start) + step, 0, len(starts) - 1)
                        found[k[(tried[k] == item) & (np.abs(start - starts[k]) <= 4 + 2 * edits[item])]] = True
                # The next walk is for the trials that are left.
                left = np.flatnonzero(~found)
                size = np.diff(starts, append=len(text) + 8)[left]
                text = text[ranges(starts[left] - 8, size)]
                trials[band] = (tried[left], text, np.cumsum(size) - size + 8)
                self.recalls[band] = 1 - len(left) / total[band]
                idle[band] = 0 if found.any() else idle[band] + 1
                if idle[band] > IDLE_WALKS and self.recalls[band] < target:
                    sizes = [len(items[i]) for i in self.bands[band]]
                    raise RuntimeError(
                        f"items of {min(sizes)} to {max(sizes)} words are found with a recall of"
                        f" {self.recalls[band]:.3f} only, below {target}, after {len(self.walks)} walks"
                    )
        self.recall = min(self.recalls.values(), default=1.0)
        self._masks: dict[int, dict[int, int]] = {}
        self._pairs = np.zeros(1 << 20, bool)
        for i in members:
            self._pairs[self._pair(np.int64(i), items[i])] = True

    def _trial(self, members: list[int], random) -> tuple[np.ndarray, np.ndarray]:
        """A text with each item once, edited as much as allowed, and where each begins."""
        parts, starts, at = [], [], 0
        for i in members:
            words = list(self.items[i])
            for _ in range(self.edits[i]):
                k, kind = int(random.integers(len(words))), random.integers(3)
                new = np.uint64(random.integers(1 << 63))
                if kind == 0:
                    words[k] = new
                elif kind == 1:
                    words.insert(k, new)
                else:
                    del words[k]
            around = random.integers(1 << 63, size=8).astype(np.uint64)
            parts += [around, np.array(words, np.uint64)]
            starts.append(at + 8)
            at += 8 + len(words)
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(starts, np.int64)

    def _add_walk(self, random, bands: list[int]) -> None:
        walk = len(self.walks)
        sets = []
        for band in bands:
            members = self.bands[band]
            most = band_steps(band)
            length = max(len(self.items[i]) for i in members)
            table = np.zeros((len(members), length + most + 1), np.uint64)
            for row, i in enumerate(members):
                table[row, : len(self.items[i])] = self.items[i]
                # Behind the item stands nothing that a text could have.
                table[row, len(self.items[i]) :] = mix(np.array([i], np.uint64) + np.uint64(1 << 40))
            rows = np.arange(len(members))
            at = np.zeros(len(members), np.int64)
            seen, places = [], []
            for j in range(most):
                if j % 64 == 0:
                    bits = _bits(table, walk, j // 64)
                seen.append(table[rows, at])
                places.append(at.copy())
                at += ((bits[rows, at] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
            for _ in range(SETS_PER_WALK):
                steps = tuple(sorted(random.choice(most, SAMPLES, replace=False).tolist()))
                key = seen[steps[0]]
                tables = []
                for k, j in enumerate(steps):
                    key = seen[j] if k == 0 else _join(key, seen[j])
                    marks = np.zeros(1 << 16, bool)
                    marks[(key & _LOW).astype(np.int64)] = True
                    tables.append(marks)
                order = np.argsort(key)
                sets.append(
                    _Set(steps, tables, key[order], np.array(members)[order], places[steps[0]][order])
                )
        self.walks.append(sets)

    def candidates(self, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(items, starts) whose keys agree at some set; starts are about right."""
        for walk in range(len(self.walks)):
            yield from self._by_walk(words, walk)

    def _by_walk(self, words: np.ndarray, walk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sets = self.walks[walk]
        last = max((s.steps[-1] for s in sets), default=-1)
        text = np.concatenate([words, np.zeros(last + 2, np.uint64)])
        at = np.arange(len(words))
        live: list[list] = []  # set, samples so far, walks, key, place at the first sample
        for j in range(last + 1):
            if j % 64 == 0:
                bits = _bits(text, walk, j // 64)
            here = None
            for s in sets:
                if s.steps[0] == j:
                    if here is None:
                        here = text[at]
                        low = (here & _LOW).astype(np.int64)
                    rows = np.flatnonzero(s.tables[0][low])
                    live.append([s, 1, rows, here[rows], at[rows]])
            for state in live:
                s, k, rows, key, place = state
                if s.steps[k] == j:
                    key = _join(key, text[at[rows]])
                    good = s.tables[k][(key & _LOW).astype(np.int64)]
                    state[1:] = [k + 1, rows[good], key[good], place[good]]
            for s, k, rows, key, place in live:
                if k == SAMPLES and len(key):
                    first = np.searchsorted(s.keys, key, "left")
                    n = np.searchsorted(s.keys, key, "right") - first
                    which = ranges(first, n)
                    yield s.items[which], np.repeat(place, n) - s.offsets[which]
            live = [x for x in live if x[1] < SAMPLES]
            at = at + ((bits[at] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
            if j % 3 == 2 and len(at) > 1:
                keep = np.ones(len(at), bool)
                np.not_equal(at[1:], at[:-1], out=keep[1:])
                moved = np.cumsum(keep) - 1
                at = at[keep]
                for state in live:
                    # Walks of one key that have met are one candidate.
                    rows = moved[state[2]]
                    new = np.ones(len(rows), bool)
                    new[1:] = (rows[1:] != rows[:-1]) | (state[3][1:] != state[3][:-1])
                    state[2:] = [rows[new], state[3][new], state[4][new]]

    def _pair(self, item: np.ndarray, words: np.ndarray) -> np.ndarray:
        return (mix(words + np.asarray(item).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(
            np.int64
        )

    def shared(self, items: np.ndarray, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For each item the number of words of its stretch low:high that the item has, or some more."""
        if not len(items):
            return np.zeros(0, np.int64)
        size = high - low
        has = self._pairs[self._pair(np.repeat(items, size), words[ranges(low, size)])]
        return np.add.reduceat(has.astype(np.int64), np.cumsum(size) - size)

    def _mask(self, item: int) -> dict[int, int]:
        found = self._masks.get(item)
        if found is None:
            found = {}
            for k, word in enumerate(self.items[item].tolist()):
                found[word] = found.get(word, 0) | 1 << k
            self._masks[item] = found
        return found

    def occurrences(self, item: int, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, edits) of stretches within the item's edit distance, exactly.

        Bit-parallel dynamic programming: the distance of the item to the best stretch
        that ends at each word. Ends closer than half an item are one occurrence, the one
        with the fewest edits, and its start is the latest that gives that distance.
        """
        ends = _distances(self._mask(item), len(self.items[item]), words.tolist())
        most, half = self.edits[item], len(self.items[item]) // 2
        found, best, last = [], None, 0
        for end, edits in enumerate(ends, 1):
            if edits > most:
                continue
            if best is not None and end - last > half:
                found.append(best)
                best = None
            if best is None or edits < best[1]:
                best = (end, edits)
            last = end
        if best is not None:
            found.append(best)
        out = []
        for end, edits in found:
            lengths = range(max(0, len(self.items[item]) - edits), len(self.items[item]) + edits + 1)
            back = _whole(self.items[item].tolist()[::-1], words[max(0, end - lengths[-1]) : end].tolist()[::-1])
            start = next((end - n for n in lengths if n < len(back) and back[n] == edits), end)
            out.append((start, end, edits))
        return out


def _distances(mask: dict[int, int], m: int, words: list[int]) -> list[int]:
    """Edit distance of a pattern to the best stretch ending at each word (Myers, Hyyro)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    out = []
    for word in words:
        eq = mask.get(word, 0)
        across = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        score += bool(right_up & top) - bool(right_down & top)
        right_up = right_up << 1 & full
        right_down = right_down << 1 & full
        up = right_down | ~(across | right_up) & full
        down = right_up & across
        out.append(score)
    return out


def _whole(pattern: list[int], words: list[int]) -> list[int]:
    """Edit distance of the pattern to each leading part of the words."""
    row = list(range(len(words) + 1))
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, w in enumerate(words, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != w))
    return row
