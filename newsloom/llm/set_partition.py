"""Sets of hashes cut into segments of the universe, and matching segments; helpers of `ngram_join`.

For Jaccard similarity 3/4 or more two sets differ in at most (|r| + |s|) / 7 elements.
The universe of 64-bit hashes is cut into ranges, one segment each: if at most H
elements differ, at most H segments do. Sets are banded by size; each band has its own
number of segments, and sets of the next larger band are cut by it as well, as partners
may be in either. In the lowest band each element is a segment of its own.
"""

from functools import cache

import numpy as np
import pyarrow as pa

from newsloom.llm.words import mix, ranges

#: Sizes up to which a band reaches; each edge is 4/3 of the one before, as is a partner's size.
LOWEST_EDGE = 32
#: A signature found in more sets than this is frequent: it costs more than it tells.
MOST_SETS = 64

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xC2B2AE3D27D4EB4F)


@cache
def edges() -> np.ndarray:
    out = [LOWEST_EDGE]
    while out[-1] < 1 << 31:
        out.append(out[-1] * 4 // 3)
    return np.array(out, np.int64)


def bands(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges(), sizes, "left")


@cache
def segments(band: int) -> int:
    """Segments of a band: more than the most elements that may differ, with room for empty and frequent ones."""
    most = int(edges()[band]) / 3
    return int(1.25 * (most + 1) + 3 * most**0.5) + 1


def differing(r, s):
    """The most elements in which linked sets of these sizes differ."""
    return (r + s) // 7


def most_differing(sizes: np.ndarray, band: np.ndarray, own: bool) -> np.ndarray:
    """... for any partner that is looked for in this segmentation: larger ones in the set's own, else smaller."""
    if own:
        return differing(sizes, sizes * 4 // 3)
    return differing(sizes, edges()[np.maximum(band - 1, 0)])


def cut(values: np.ndarray, sizes: np.ndarray, band: np.ndarray):
    """(set, segment, start, end) of the nonempty segments of sorted sets, one after another in ``values``.

    ``band``: the segmentation that each set is cut by.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    number = np.array([0 if b == 0 else segments(int(b)) for b in range(int(band.max(initial=0)) + 1)], np.uint64)
    n = number[band][owner]
    place = np.where(
        n == 0, values, ((values >> np.uint64(32)) * n) >> np.uint64(32)
    )
    new = np.ones(len(values), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    start = np.flatnonzero(new)
    return owner[start], place[start], start, np.append(start[1:], len(values))


def signatures(values: np.ndarray, owner, place, start, end, band: np.ndarray) -> np.ndarray:
    """A hash of each segment: its band, its number and its elements."""
    sums = np.add.reduceat(mix(values), start) if len(start) else np.zeros(0, np.uint64)
    return mix(sums ^ (mix(place * _C1) + band[owner].astype(np.uint64) * _C2))


def neighbours(values: np.ndarray, owner, place, start, end, band: np.ndarray):
    """(segment, hash) of each segment of two or more elements with one of them taken out."""
    size = end - start
    many = np.flatnonzero(size > 1)
    sums = np.add.reduceat(mix(values), start)[many] if len(start) else np.zeros(0, np.uint64)
    which = np.repeat(np.arange(len(many)), size[many])
    left = sums[which] - mix(values[ranges(start[many], size[many])])
    tag = mix(place[many] * _C1) + band[owner[many]].astype(np.uint64) * _C2
    return many[which], mix(left ^ tag[which])


def parity(values: np.ndarray) -> bytes:
    """A bit for each ending of hashes: whether an odd number of elements has it.

    There are two to four times as many endings as elements.
    """
    width = 1 << max(6, int(2 * len(values)).bit_length())
    ends = (values & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(ends, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(r: int, one: bytes, s: int, two: bytes) -> bool:
    """Whether sets of ``r`` and ``s`` elements can be linked, by their parities.

    An element that only one set has changes one bit, so these differ in no more bits than the
    sets in elements, and no link is refused. The longer parity is folded to the shorter.
    """
    x, y = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int.from_bytes((x ^ y).tobytes()).bit_count() <= differing(r, s)


# Entries are packed: one row holds those of many sets for one bucket. As buckets grow in
# number with the input, a bucket gets one entry of most sets, and an entry must be short
# with all that is said of its set.

ENTRY = np.dtype([("sig", "<u4"), ("set", "<u4"), ("role", "u1")])
#: Roles: the set's own band or the one below; a whole segment or one without an element;
#: a mark that a signature is frequent where the entries were made.
OWN, LOWER, OWN_LESS, LOWER_LESS, FREQUENT = 0, 1, 2, 3, 4


KIND = [("set", "<u4"), ("role", "u1")]


#: In a kind's tag: the role, whether its set differs from the one before, and how many entries it has.
_NEW, _COUNT, _MANY = 8, 4, 15


def pack(sig: np.ndarray, who: np.ndarray, kinds: np.ndarray) -> bytes:
    """Entries of one bucket, those of a set together.

    The bucket stands for the highest bits of a signature; its last four bytes tell it
    from others. A set's short number is written once for all its kinds, each of which
    takes one byte and, with 15 entries or more, four for their number. Bands go unsaid:
    they are in the signatures, and follow from a set and its role. Numbers are written as
    steps, byte by byte of their places, and compressed with the kinds if that is shorter.
    """
    present, which = np.unique(who, return_inverse=True)
    some = kinds[present]
    by_set = np.argsort(some["set"], kind="stable")
    rank = np.empty(len(by_set), np.int64)
    rank[by_set] = np.arange(len(by_set))
    which, some = rank[which], some[by_set]
    low = sig[np.argsort(which, kind="stable")] & np.uint64(0xFFFFFFFF)
    count = np.bincount(which, minlength=len(some))
    new = np.ones(len(some), bool)
    new[1:] = some["set"][1:] != some["set"][:-1]
    tags = some["role"] | (new * _NEW) | (np.minimum(count, _MANY) << _COUNT)
    sets = some["set"][new]
    many = count[count >= _MANY]
    steps = np.diff(sets, prepend=np.zeros(1, "<u4")).astype("<u4").view("u1").reshape(-1, 4)
    about = steps.T.tobytes() + many.astype("<u4").tobytes() + tags.astype("u1").tobytes()
    short = pa.compress(about, codec="zstd", asbytes=True)
    return b"".join(
        (
            np.array([len(sig), len(some), len(sets), len(many)], "<u4").tobytes(),
            low.astype("<u4").tobytes(),
            short if len(short) < len(about) else about,
        )
    )


def unpack(blob: bytes) -> np.ndarray:
    n, k, m, large = (int(x) for x in np.frombuffer(blob, "<u4", 4))
    about, size = blob[16 + 4 * n :], 4 * m + 4 * large + k
    if len(about) < size:
        about = pa.decompress(about, size, codec="zstd", asbytes=True)
    steps = np.ascontiguousarray(np.frombuffer(about, "u1", 4 * m).reshape(4, m).T).view("<u4").ravel()
    sets = np.cumsum(steps, dtype="<u4")
    many = np.frombuffer(about, "<u4", large, 4 * m)
    tags = np.frombuffer(about, "u1", k, 4 * m + 4 * large)
    count = (tags >> _COUNT).astype(np.int64)
    count[count == _MANY] = many
    out = np.empty(n, ENTRY)
    out["sig"] = np.frombuffer(blob, "<u4", n, 16)
    out["set"] = np.repeat(sets[np.cumsum((tags & _NEW) > 0) - 1], count)
    out["role"] = np.repeat(tags & (_NEW - 1), count)
    return out


def thin_out(sig: np.ndarray, who: np.ndarray, mark: int, most: int = MOST_SETS):
    """Replace the entries of signatures that are frequent already here by one of ``mark`` each.

    Returns the entries to send, in order, and those that are not sent.
    """
    order = np.argsort(sig)
    sig, who = sig[order], who[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(sig)))
    often = np.repeat(count > most, count)
    held = (sig[often], who[often])
    marks = start[count > most]
    send = ~often
    send[marks] = True
    who = who.copy()
    who[marks] = mark
    return (sig[send], who[send]), held


def matches(entries: np.ndarray, most: int = MOST_SETS):
    """((set, set, roles, matches) of pairs, entries of frequent signatures) of a bucket's entries.

    Roles are 0 for two sets in their own band, 1 if the first set is in its lower band, 2 if
    the second is. Each set counts once for a signature and role. Sets of the upper band are not
    paired with each other here, nor are two segments that both lack an element.
    """
    entries = entries[np.argsort(entries["sig"], kind="stable")]
    sig = entries["sig"]
    same = np.zeros(len(sig), bool)
    same[1:] = sig[1:] == sig[:-1]
    same[:-1] |= same[1:]
    alone_mark = entries["role"] == FREQUENT
    entries = entries[same | alone_mark]
    order = np.lexsort((entries["role"], entries["set"], entries["sig"]))
    entries = entries[order]
    new = np.ones(len(entries), bool)
    for name in ("sig", "set", "role"):
        if name == "sig":
            new[1:] = entries[name][1:] != entries[name][:-1]
        else:
            new[1:] |= entries[name][1:] != entries[name][:-1]
    entries = entries[new]
    sig = entries["sig"]
    head = np.ones(len(sig), bool)
    head[1:] = sig[1:] != sig[:-1]
    start = np.flatnonzero(head)
    count = np.diff(np.append(start, len(sig)))
    marked = np.add.reduceat(entries["role"] == FREQUENT, start) > 0 if len(start) else np.zeros(0, bool)
    often = np.repeat((count > most) | marked, count)
    plain = entries["role"] != FREQUENT
    frequent = entries[often & plain]
    entries, sig = entries[~often], sig[~often]
    found = []
    at = np.arange(len(sig))
    for step in range(1, most + 1):
        at = at[at + step < len(sig)]
        at = at[sig[at] == sig[at + step]]
        if not len(at):
            break
        a, b = entries[at], entries[at + step]
        ok = a["set"] != b["set"]
        lower = (a["role"] % 2 == 1) & (b["role"] % 2 == 1)
        less = (a["role"] >= OWN_LESS) & (b["role"] >= OWN_LESS)
        ok &= ~lower & ~less
        a, b, swap = a[ok], b[ok], a["set"][ok] > b["set"][ok]
        first, second = np.where(swap, b["role"], a["role"]) % 2, np.where(swap, a["role"], b["role"]) % 2
        found.append((np.minimum(a["set"], b["set"]), np.maximum(a["set"], b["set"]), first + 2 * second))
    none = np.zeros(0, "<u4")
    low, high, roles = (np.concatenate(x) for x in zip(*found)) if found else (none, none, np.zeros(0, "u1"))
    order = np.lexsort((roles, high, low))
    low, high, roles = low[order], high[order], roles[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (roles[1:] != roles[:-1])
    start = np.flatnonzero(new)
    times = np.diff(np.append(start, len(low)))
    return (low[start], high[start], roles[start], times), frequent
