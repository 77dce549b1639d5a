"""Documents whose sets of word n-grams have a Jaccard similarity of 3/4 or more.

An exact join by partitioning the universe of n-grams (see `set_partition`). Nodes are
distinct sets, so that copies are one node from the start.

1. Every set sends the signatures of its segments, for its own size band and the one
   below. Pairs with enough common signatures are candidates.
2. Signatures found in more than `MOST_SETS` sets are frequent and are skipped: the
   other segments must do. A set that has too few of them left to guarantee its links
   sends, in a second round among such sets, also each segment with one element taken
   out; a segment that allows for one difference counts twice. So the cheap exact
   matches are used first and the dearer ones only where frequent segments take their
   place.
3. Sets that even so are not covered are mostly made of frequent segments: large groups
   of near copies. They are held against one member of each frequent segment's group;
   those that this leaves unconnected are then held, in blocks, against the whole of
   the component that they share a frequent segment with.

Signatures travel with a short number of their set, the first `NUMBER_BITS` of its hash.
What is found of a number holds for every set that has it, and sets with one number are
candidates, so that no link is lost by it.

Every candidate that the parities of the sets do not rule out (see `set_partition`) is
verified on the whole sets. Links within a component that is already connected are not
verified one by one.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm import set_partition as sp
from newsloom.llm.components import components
from newsloom.llm.words import hashed_words, mix, ranges, slices
from newsloom.llm.workers import release, with_code
from newsloom.operators.membership import likely_members
from newsloom.sources.staging import row_count, stage, stage_counted

WORDS = 5
#: Text bytes for each bucket of signatures, a million and a half of entries with nine bytes each.
BUCKET_BYTES = 12 << 20
#: Bits of a set's short number, 32 at most. Of N sets some N * N / 2**33 pairs share one.
NUMBER_BITS = 32
#: Entries that a task packs at a time.
CHUNK_ENTRIES = 700_000
#: Ids (and signatures beside them) that may be broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
PIVOT_SIGNATURES = 8
#: Sets of a task that holds two lots of sets against each other.
BLOCK_SETS, SLICE_SETS = 1000, 2000

_PAIR, _FREQUENT, _SET = 0, 1, 2
_OUT = "kind int, a bigint, b bigint, x int, y int, z int"
_WEIGHTS = mix(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)
_ROW = np.dtype([("id", "<i8"), ("named", "u1"), ("key", "<u8"), ("x", "<i4"), ("y", "<i4"), ("z", "<i4")])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each row, one row after another, and their numbers.

    With fewer than n words the whole sequence is one n-gram; without words there is none.
    """
    words, at = hashed_words(data, offsets, lower=True, punctuation=True)
    count = np.diff(at)
    whole = np.zeros(len(words), np.uint64)
    for k in range(min(n, len(words))):
        whole[: len(words) - k] += words[k:] * _WEIGHTS[k]
    left = np.repeat(at[1:], count) - np.arange(len(words))
    for row in np.flatnonzero((count > 0) & (count < n)).tolist():
        a, b = at[row], at[row + 1]
        whole[a] = (words[a:b] * _WEIGHTS[: b - a]).sum() + np.uint64(b - a)
        left[a] = n
    values = mix(whole[left >= n])
    sizes = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    sums = np.concatenate([[0], np.cumsum(new)])
    return values[new], sums[ends] - sums[ends - sizes]


def set_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for the empty set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)))])
    ends = np.cumsum(sizes)
    keys = mix(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)) | np.uint64(1)
    return np.where(sizes > 0, keys, np.uint64(0))


class _Sender:
    """Collects entries and rows of a task and packs them by bucket."""

    def __init__(self, buckets: int, bits: int):
        self.buckets = buckets
        self.shift = np.uint64(64 - bits)
        self.clear()

    def clear(self) -> None:
        self.sig, self.who, self.kinds, self.rows = [], [], [], []
        self.entries = self.sets = 0

    def add(self, sig: np.ndarray, owner: np.ndarray, keys: np.ndarray, role: int) -> None:
        kinds = np.empty(len(keys), sp.KIND)
        kinds["set"], kinds["role"] = keys >> self.shift, role
        self.sig.append(sig)
        self.who.append((owner + self.sets).astype(np.int32))
        self.kinds.append(kinds)
        self.sets += len(keys)
        self.entries += len(sig)

    def bucket(self, sig: np.ndarray) -> np.ndarray:
        return (((sig >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)).astype(np.int64)

    def name(self, sig: np.ndarray) -> np.ndarray:
        """A signature as reducers know it: its bucket and four bytes."""
        return (self.bucket(sig).astype(np.uint64) << np.uint64(32)) | (sig & np.uint64((1 << 32) - 1))

    def flush(self) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, bytes]] = []
        if self.sig:
            kinds = np.concatenate([*self.kinds, np.array([(0, sp.FREQUENT)], sp.KIND)])
            (sig, who), held = sp.thin_out(np.concatenate(self.sig), np.concatenate(self.who), len(kinds) - 1)
            edge = np.searchsorted(self.bucket(sig), np.arange(self.buckets + 1))
            for k in np.flatnonzero(np.diff(edge)).tolist():
                a, b = edge[k], edge[k + 1]
                out.append((k, _PAIR, sp.pack(sig[a:b], who[a:b], kinds)))
            out += self._rows(_FREQUENT, _frequent_rows(kinds[held[1]], self.name(held[0])))
        for rows in self.rows:
            out += self._rows(_SET, rows)
        self.clear()
        for first in range(0, len(out), 512):
            part = out[first : first + 512]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in part], pa.int32()),
                    pa.array([r[1] for r in part], pa.int32()),
                    pa.array([r[2] for r in part], pa.binary()),
                ],
                ["bucket", "kind", "blob"],
            )

    def _rows(self, kind: int, rows: np.ndarray) -> list[tuple[int, int, bytes]]:
        """Rows that only pass through, spread over the buckets."""
        if not len(rows):
            return []
        size = 4096
        base = int(rows["key"][0] % np.uint64(self.buckets))
        return [
            ((base + k) % self.buckets, kind, rows[a : a + size].tobytes())
            for k, a in enumerate(range(0, len(rows), size))
        ]


def _frequent_rows(kinds: np.ndarray, names: np.ndarray) -> np.ndarray:
    rows = np.zeros(len(kinds), _ROW)
    rows["id"], rows["named"], rows["key"] = names.astype(np.int64), 1, kinds["set"]
    rows["x"] = kinds["role"]
    return rows


def _reduce(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    bucket = key[0].as_py()
    kinds = table.column("kind").to_numpy()
    blobs = table.column("blob")
    entries = [sp.unpack(blobs[i].as_py()) for i in np.flatnonzero(kinds == _PAIR).tolist()]
    parts = []
    if entries:
        (a, b, roles, times), frequent = sp.matches(np.concatenate(entries))
        parts.append((_PAIR, a.astype(np.int64), b.astype(np.int64), roles, times, times, None))
        names = (np.uint64(bucket) << np.uint64(32)) | frequent["sig"].astype(np.uint64)
        role, zero = frequent["role"], np.zeros(len(frequent), np.int32)
        parts.append((_FREQUENT, frequent["set"].astype(np.int64), names.view(np.int64), role, zero, zero, None))
    for kind in (_FREQUENT, _SET):
        rows = [np.frombuffer(blobs[i].as_py(), _ROW) for i in np.flatnonzero(kinds == kind).tolist()]
        if rows:
            r = np.concatenate(rows)
            key_of = np.ascontiguousarray(r["key"]).view(np.int64)
            if kind == _FREQUENT:
                parts.append((kind, key_of, r["id"], r["x"], r["y"], r["z"], None))
            else:
                parts.append((kind, r["id"], key_of, r["x"], r["y"], r["z"], r["named"] == 0))
    tables = [
        pa.table(
            {
                "kind": pa.array(np.full(len(a), kind, np.int32)),
                "a": pa.array(np.ascontiguousarray(a), pa.int64(), mask=mask),
                "b": pa.array(np.ascontiguousarray(b), pa.int64()),
                "x": pa.array(x.astype(np.int32)),
                "y": pa.array(y.astype(np.int32)),
                "z": pa.array(z.astype(np.int32)),
            }
        )
        for kind, a, b, x, y, z, mask in parts
    ]
    if not tables:
        ints = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.table({n: pa.array([], t) for n, t in zip(("kind", "a", "b", "x", "y", "z"), ints)})
    out = pa.concat_tables(tables)
    del entries, parts, tables, blobs
    release()
    return out


def _meet(entries: DataFrame, label: str) -> DataFrame:
    return stage(entries.groupBy("bucket").applyInArrow(_reduce, _OUT), label)


def _first_round(docs: DataFrame, buckets: int, bits: int) -> DataFrame:
    """All sets' segments; rows (doc, set, elements, segments in its own and the lower band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets, bits)
        sent: set[int] = set()
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in slices(batch.column(1)):
                values, sizes = shingle_sets(data, offsets)
                keys = set_keys(values, sizes)
                rows = np.zeros(len(sizes), _ROW)
                own_ids = ids.slice(row, len(sizes))
                rows["id"] = own_ids.fill_null(0).to_numpy(zero_copy_only=False)
                rows["named"] = own_ids.is_valid().to_numpy(zero_copy_only=False)
                rows["key"], rows["x"] = keys, sizes
                band = sp.bands(sizes)
                # Copies in one task send their segments once.
                first = np.zeros(len(keys), bool)
                for i, key in enumerate(keys.tolist()):
                    if key and key not in sent:
                        sent.add(key)
                        first[i] = True
                if len(sent) > 1_000_000:
                    sent.clear()
                for role, column in ((sp.OWN, "y"), (sp.LOWER, "z")):
                    use = (sizes > 0) & (band >= role)
                    if not use.any():
                        continue
                    part = values[np.repeat(use, sizes)]
                    cut_by = (band - role)[use]
                    owner, place, start, end = sp.cut(part, sizes[use], cut_by)
                    counts = np.zeros(len(sizes), np.int64)
                    counts[use] = np.bincount(owner, minlength=int(use.sum()))
                    rows[column] = counts
                    sends = first[use][owner]
                    sig = sp.signatures(part, owner, place, start, end, cut_by)[sends]
                    sender.add(sig, owner[sends], keys[use], role)
                sender.rows.append(rows)
                if sender.entries >= CHUNK_ENTRIES:
                    yield from sender.flush()
        yield from sender.flush()
        release()

    return docs.select("doc_id", "text").mapInArrow(run, "bucket int, kind int, blob binary")


def _second_round(docs: DataFrame, buckets: int, bits: int) -> DataFrame:
    """Segments whole and with an element taken out; rows (set, role, segments of two and more elements, single ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(buckets, bits)
        for batch in batches:
            for row, data, offsets in slices(batch.column(1)):
                values, sizes = shingle_sets(data, offsets)
                n = len(sizes)
                keys = set_keys(values, sizes)
                band, roles, thin = (batch.column(k).slice(row, n).to_numpy(zero_copy_only=False) for k in (2, 3, 4))
                for role in (sp.OWN, sp.LOWER):
                    use = roles == role
                    if not use.any():
                        continue
                    part, key, cut_by = values[np.repeat(use, sizes)], keys[use], band[use].astype(np.int64)
                    owner, place, start, end = sp.cut(part, sizes[use], cut_by)
                    segment, less = sp.neighbours(part, owner, place, start, end, cut_by)
                    sender.add(sp.signatures(part, owner, place, start, end, cut_by), owner, key, role)
                    sender.add(less, owner[segment], key, role + sp.OWN_LESS)
                    # Too few segments by chance: each element is one.
                    alone = np.repeat(np.arange(len(key)), sizes[use])
                    few = thin[use][alone]
                    tag = mix(cut_by.astype(np.uint64) + np.uint64(1 << 32))
                    sender.add(mix(part[few] ^ tag[alone[few]]), alone[few], key, role)
                    rows = np.zeros(len(key), _ROW)
                    rows["id"], rows["named"], rows["key"] = key.view(np.int64), 1, role
                    rows["x"] = np.bincount(owner[end - start > 1], minlength=len(key))
                    rows["y"] = np.bincount(owner[end - start == 1], minlength=len(key))
                    sender.rows.append(rows)
                if sender.entries >= CHUNK_ENTRIES:
                    yield from sender.flush()
        yield from sender.flush()
        release()

    return docs.select("doc_id", "text", "band", "role", "thin").mapInArrow(run, "bucket int, kind int, blob binary")


def _only(docs: DataFrame, wanted: DataFrame, weight: int) -> DataFrame:
    """``docs`` joined with ``wanted`` (__id ...), broadcast if its ``weight`` is small."""
    right = F.broadcast(wanted) if weight <= BROADCAST_IDS else wanted
    return docs.select("doc_id", "text").join(right, F.col("doc_id") == F.col("__id"))


def _sets_of(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, n, elements, parity`` of the wanted sets, from one document each."""
    ids = stage(
        classes.join(keys.select("key").distinct(), "key").select(F.col("doc_id").alias("__id")), "wanted-sets"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in slices(batch.column(1)):
                values, sizes = shingle_sets(data, offsets)
                ends = np.cumsum(sizes)
                bounds = list(zip((ends - sizes).tolist(), ends.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(set_keys(values, sizes).view(np.int64)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array([values[a:b].tobytes() for a, b in bounds], pa.binary()),
                        pa.array([sp.parity(values[a:b]) for a, b in bounds], pa.binary()),
                    ],
                    ["key", "n", "elements", "parity"],
                )
        release()

    wanted = ids.count()
    texts = _only(docs, ids, wanted).select("doc_id", "text")
    sets = stage_counted(texts.mapInArrow(run, "key bigint, n bigint, elements binary, parity binary"), "sets")
    # More rows than were asked for: a doc_id is on several rows.
    return sets if row_count(sets) == wanted else stage(sets.dropDuplicates(["key"]), "sets")


def _some(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """``sets`` without most of those that are not in the column of ``keys`` (staged and counted).

    An exact join follows; this keeps whole sets out of its shuffle.
    """
    (key,) = keys.columns
    if row_count(keys) > BROADCAST_IDS:
        return likely_members(sets, keys, key)
    return sets.join(F.broadcast(keys), F.col("key") == F.col(key), "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    ends = pairs.select(F.col("a").alias("__end")).union(pairs.select("b")).distinct()
    return stage_counted(ends, "ends")


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (staged) that are links, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                r, s = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(r) > len(s):
                    r, s = s, r
                place = np.minimum(np.searchsorted(s, r), len(s) - 1)
                common = int((s[place] == r).sum())
                linked.append(100 * common >= 75 * (len(r) + len(s) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))
        release()

    a = sets.select(F.col("key").alias("a"), F.col("elements").alias("ea"))
    b = sets.select(F.col("key").alias("b"), F.col("elements").alias("eb"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "ea", "eb").mapInArrow(run, "a bigint, b bigint")


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` without those that the sets' parities show to be no links; some bytes a set are moved for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(2, 6))
            yield batch.select([0, 1]).filter(pa.array([sp.may_link(*x) for x in zip(*columns)], pa.bool_()))
        release()

    a = sets.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    b = sets.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "na", "pa", "nb", "pb")
    return stage(both.mapInArrow(run, "a bigint, b bigint"), "possible")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` that are links; whole sets are moved only for pairs that may be."""
    possible = _possible(pairs, sets)
    return _verify(possible, _some(sets, _ends(possible)))


def _links_across(table: pa.Table) -> pa.Table:
    """Links of asking sets with the others, one for each of the others and component; by counting common elements."""
    asks = table.column("asks").to_numpy()
    keys, roots = table.column("key").to_numpy(), table.column("root").to_numpy()
    elements = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("elements").combine_chunks()]
    first, others = np.flatnonzero(asks), np.flatnonzero(~asks)
    sizes = np.array([len(elements[i]) for i in first], np.int64)
    values = np.concatenate([elements[i] for i in first]) if len(first) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(first)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    a, b = [], []
    for j in others.tolist():
        own = elements[j]
        low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
        common = np.bincount(owner[ranges(low, high - low)], minlength=len(first))
        linked = np.flatnonzero((100 * common >= 75 * (sizes + len(own) - common)) & (roots[first] != roots[j]))
        if len(linked):
            _, one = np.unique(roots[first[linked]], return_index=True)
            a += keys[first[linked[one]]].tolist()
            b += [int(keys[j])] * len(one)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _near_sizes(a: str, b: str) -> Column:
    return 4 * F.least(a, b) >= 3 * F.greatest(a, b)


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are not in one component yet."""
    x = roots.select(F.col("node").alias("a"), F.col("root").alias("__ra"))
    y = roots.select(F.col("node").alias("b"), F.col("root").alias("__rb"))
    return (
        pairs.join(x, "a", "left")
        .join(y, "b", "left")
        .filter(F.coalesce("__ra", "a") != F.coalesce("__rb", "b"))
        .drop("__ra", "__rb")
    )


def _band_column(n: Column) -> Column:
    tops = F.array(*(F.lit(int(e)) for e in sp.edges()))
    return F.size(F.filter(tops, lambda e: e < n))


class _Join:
    """The steps over the written tables."""

    def __init__(self, docs: DataFrame):
        spark = with_code(docs).sparkSession
        self.docs = docs
        size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = max(partitions, -(-size // BUCKET_BYTES))
        self.bits = NUMBER_BITS
        first = _meet(_first_round(docs, self.buckets, self.bits), "segments")
        self.rows = first.filter(F.col("kind") == _SET).select(
            F.col("a").alias("doc_id"), F.col("b").alias("key"), F.col("x").alias("n"), "y", "z"
        )
        self.classes = stage(
            self.rows.filter("n > 0")
            .groupBy("key")
            .agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("y").alias("own"), F.max("z").alias("lower"))
            .withColumn("band", _band_column(F.col("n")))
            .withColumn("number", F.shiftrightunsigned("key", 64 - self.bits)),
            "classes",
        )
        self.frequent = stage(
            first.filter(F.col("kind") == _FREQUENT)
            .select(F.col("a").alias("number"), F.col("b").alias("sig"), F.col("x").alias("role"))
            .distinct(),
            "frequent",
        )
        self.roles = stage(self._roles(), "roles")
        found = self._pairs(first, self.roles, 1)
        self.candidates = stage(found.union(self._namesakes()), "candidates")

    def _roles(self) -> DataFrame:
        """``key, number, band, role, n, left`` (segments that are not frequent), ``most`` (that may differ)."""
        top = F.element_at(F.array(*(F.lit(int(e)) for e in sp.edges())), F.greatest(F.col("band"), F.lit(1)))
        n = F.col("n").cast("bigint")
        own = self.classes.select(
            "key", "number", "band", F.lit(sp.OWN).alias("role"), n.alias("n"), F.col("own").alias("has"),
            F.expr("(n + n * 4L div 3) div 7").alias("most"),
        )
        lower = self.classes.filter("band > 0").select(
            "key", "number", (F.col("band") - 1).alias("band"), F.lit(sp.LOWER).alias("role"), n.alias("n"),
            F.col("lower").alias("has"), F.floor((n + top) / 7).alias("most"),
        )
        often = self.frequent.groupBy("number", "role").agg(F.count("*").alias("often"))
        return (
            own.union(lower)
            .join(often, ["number", "role"], "left")
            .select("key", "number", "band", "role", "n", "has", (F.col("has") - F.coalesce("often", F.lit(0))).alias("left"), "most")
        )

    def _pairs(self, met: DataFrame, roles: DataFrame, points: int) -> DataFrame:
        """Pairs with the matches that their sizes ask for; ``left``: a set's points that can show a match.

        Segments that do not match take up as many differences as they have points.
        """
        roles = roles.select("key", "number", "band", "role", "n", "left")
        one, two = (roles.select(*(F.col(c).alias(f"{c}_{end}") for c in roles.columns)) for end in "ab")
        # Dealt by one side first, so that counting and the first join share a shuffle, and
        # what no partner of that side could make up for goes before the second.
        return (
            met.filter(F.col("kind") == _PAIR)
            .select(
                F.col("a").alias("number_a"), F.col("b").alias("number_b"),
                (F.col("x") % 2).alias("role_a"), F.shiftright("x", 1).alias("role_b"), F.col("y").alias("times"),
            )
            .repartition("number_a", "role_a")
            .groupBy("number_a", "number_b", "role_a", "role_b")
            .agg(F.sum("times").alias("matches"))
            .join(one, ["number_a", "role_a"])
            .filter(F.expr(f"{points} * matches >= left_a - (n_a + n_a * 4 div 3) div 7"))
            .join(two, ["number_b", "role_b"])
            .filter(F.col("band_a") == F.col("band_b"))
            .filter(_near_sizes("n_a", "n_b"))
            .filter(F.expr(f"{points} * matches >= greatest(left_a, left_b) - (n_a + n_b) div 7"))
            .select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"), "matches")
        )

    def _namesakes(self) -> DataFrame:
        """Pairs of sets with one short number, as candidates."""
        keys = self.classes.groupBy("number").agg(F.collect_list("key").alias("keys")).filter(F.size("keys") > 1)
        pairs = keys.select(F.explode("keys").alias("a"), "keys").select("a", F.explode("keys").alias("b"))
        return pairs.filter("a < b").withColumn("matches", F.lit(0).cast("bigint"))

    def _more(self, need: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Candidates by one-deletion neighbourhoods, and the roles that these do not cover."""
        asked = stage(
            need.join(self.classes.select("key", F.col("doc_id").alias("__id")), "key").select(
                "__id", "band", "role", (F.col("has") <= F.col("most")).alias("thin")
            ),
            "asked",
        )
        met = _meet(_second_round(_only(self.docs, asked, asked.count()), self.buckets, self.bits), "neighbours")
        lost = (
            met.filter(F.col("kind") == _FREQUENT)
            .select(F.col("a").alias("number"), F.col("b").alias("sig"), F.col("x").alias("how"))
            .distinct()
            # A frequent whole segment loses its points, one without an element the second.
            .groupBy("number", (F.col("how") % 2).alias("role"))
            .agg(F.sum(F.when(F.col("how") >= sp.OWN_LESS, 1).otherwise(2)).alias("lost"))
        )
        points = (
            met.filter(F.col("kind") == _SET)
            .groupBy(F.col("a").alias("key"), F.col("b").cast("int").alias("role"))
            .agg(F.max(2 * F.col("x") + F.col("y")).alias("points"))
        )
        scored = stage(
            need.join(points, ["key", "role"])
            .join(lost, ["number", "role"], "left")
            .select("key", "number", "band", "role", "n", "has", F.col("left").alias("plain"), "most",
                    (F.col("points") - F.coalesce("lost", F.lit(0))).alias("left")),
            "points",
        )
        rest = scored.filter("left <= most").select("key", "number", "band", "role", "n", "has", F.col("plain").alias("left"))
        return self._pairs(met, scored, 2), stage(rest, "uncovered")

    def links(self) -> DataFrame:
        """Verified links that connect every component."""
        found, wanted = self.candidates, []
        # Their segments that are not frequent cannot guarantee their links.
        need, uncovered = stage(self.roles.filter("left <= most"), "in-need"), None
        if not need.isEmpty():
            more, uncovered = self._more(need)
            found = stage(
                found.union(more).groupBy("a", "b").agg(F.max("matches").alias("matches")), "candidates"
            )
            wanted.append(uncovered.select("key"))
        ends = found.select(F.col("a").alias("key")).union(found.select("b"))
        for keys in wanted:
            ends = ends.union(keys)
        sets = _sets_of(self.docs, self.classes, ends)
        # Each set's best candidate first; then those that would connect more.
        other = found.select("a", F.col("b").alias("o"), "matches").union(found.select("b", "a", "matches"))
        best = (
            other.groupBy("a")
            .agg(F.max(F.struct("matches", "o")).alias("m"))
            .select(F.least("a", "m.o").alias("a"), F.greatest("a", "m.o").alias("b"))
            .distinct()
        )
        best = stage(best, "best")
        links = stage(_linked(best, sets), "links")
        roots = stage(components(links), "roots")
        rest = _apart(found.select("a", "b"), roots).join(best, ["a", "b"], "left_anti")
        links = stage(links.union(_linked(rest, sets)), "links")
        if uncovered is None or uncovered.isEmpty():
            return links
        return self._by_groups(links, uncovered, sets)

    def _by_groups(self, links: DataFrame, uncovered: DataFrame, sets: DataFrame) -> DataFrame:
        """Links among sets that frequent segments alone could show."""
        sigs = self.frequent.groupBy("number", "role").agg(F.sort_array(F.collect_set("sig")).alias("sigs"))
        members = stage(
            uncovered.join(sigs, ["number", "role"]).select("key", "band", "n", "sigs", F.size("sigs").alias("often")),
            "members",
        )
        roots = stage(components(links), "roots")
        pairs = stage(self._pivot_pairs(self._placed(members, roots)), "pivot-pairs")
        links = stage(links.union(_linked(pairs, sets)), "links")
        roots = stage(components(links), "roots")
        placed = stage(self._placed(members, roots), "placed")
        return stage(links.union(self._across(placed, sets)), "links")

    @staticmethod
    def _pivot_pairs(placed: DataFrame) -> DataFrame:
        """Members with the one of their group that has most frequent segments: the middle of near copies.

        Groups here are those of each member's first few segments in order of hash; what
        this leaves unconnected is seen to by `_across`.
        """
        some = placed.select("key", "n", "often", "root", F.explode(F.slice("sigs", 1, PIVOT_SIGNATURES)).alias("sig"))
        pivot = some.groupBy("sig").agg(F.max(F.struct("often", "key", "n", "root")).alias("p"))
        return (
            some.join(pivot, "sig")
            .filter((F.col("root") != F.col("p.root")) & _near_sizes("n", "p.n"))
            .select(F.least("key", "p.key").alias("a"), F.greatest("key", "p.key").alias("b"))
            .distinct()
        )

    @staticmethod
    def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
        known = roots.select(F.col("node").alias("key"), "root")
        return members.join(known, "key", "left").withColumn("root", F.coalesce("root", "key"))

    def _across(self, placed: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between components that share a frequent segment.

        Of each segment's group the members outside its largest component are held,
        in blocks, against that component's members, in slices, and against each other.
        A task has one block and one slice, and only links leave it.
        """
        spread = placed.select("key", "root", F.explode("sigs").alias("sig"))
        sides = spread.groupBy("sig", "root").agg(F.count("*").alias("size"))
        largest = sides.groupBy("sig").agg(
            F.max(F.struct("size", "root"))["root"].alias("main"), F.count("*").alias("sides")
        ).filter("sides > 1")
        asking = stage(
            spread.join(largest, "sig").filter("root <> main").select("key", "root", "main").distinct(), "asking"
        )
        mains = asking.select("main").distinct()
        every = placed.select("key", "root").distinct()
        inside = every.join(mains, F.col("root") == F.col("main"), "left_semi").withColumn("main", F.col("root"))
        asked = asking.unionByName(inside)
        blocks = asking.groupBy("main").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
        slices_ = asked.groupBy("main").agg(F.ceil(F.count("*") / SLICE_SETS).cast("int").alias("slices"))
        grid = stage(blocks.join(slices_, "main"), "grid")

        def dealt(rows: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
            place = F.pmod(F.xxhash64("key"), F.col(f"{own}s")).cast("int")
            return (
                rows.join(grid, "main")
                .withColumn(own, place)
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)))
                .select("main", "block", "slice", F.lit(asks).alias("asks"), "key", "root")
            )

        met = dealt(asking, "block", "slice", True).unionByName(dealt(asked, "slice", "block", False))
        taking_part = stage_counted(asked.select(F.col("key").alias("__end")).distinct(), "ends")
        return (
            met.join(_some(sets, taking_part).select("key", "elements"), "key")
            .groupBy("main", "block", "slice")
            .applyInArrow(_links_across, "a bigint, b bigint")
        )

    def groups(self) -> DataFrame:
        roots = components(self.links())
        placed = stage(
            self.classes.join(roots.select(F.col("node").alias("key"), "root"), "key", "left").select(
                "key", "doc_id", F.coalesce("root", "key").alias("root")
            ),
            "placed-classes",
        )
        least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        named = placed.join(least, "root").select("key", "component_id")
        return self.rows.join(named, "key", "left").select(
            "doc_id",
            F.col("n").cast("bigint").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (doc_id, text).

    A-Z are lower-cased, words end at white space; two documents are linked if their
    sets of 5-word n-grams have 100 * common >= 75 * union, and a component's id is its
    smallest doc_id. NULL and empty texts have no n-grams and are linked with nothing.
    Equal texts, repeated rows too, are in one component. Rows without doc_id get the
    component of their text, NULL if it has none. An empty table gives no row.
    """
    return _Join(docs.select("doc_id", "text")).groups()


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` reduced to the document with the smallest doc_id of each group.

    Documents without n-grams all stay, as do those without doc_id. Of repeated rows
    with one doc_id and n-grams one stays.
    """
    groups = near_groups(docs)
    goes = groups.filter("n_shingles > 0 AND doc_id <> component_id").select(F.col("doc_id").alias("__goes")).distinct()
    again = (
        groups.filter("n_shingles > 0 AND doc_id = component_id")
        .groupBy(F.col("doc_id").alias("__again"))
        .agg(F.count("*").alias("__n"))
        .filter("__n > 1")
    )
    kept = docs.join(stage(goes, "not-kept"), F.col("doc_id") == F.col("__goes"), "left_anti")
    again = stage(again, "repeated")
    if again.isEmpty():
        return kept
    ids = again.select("__again")
    once = kept.join(ids, F.col("doc_id") == F.col("__again"), "left_semi").dropDuplicates(["doc_id"])
    return kept.join(ids, F.col("doc_id") == F.col("__again"), "left_anti").union(once)
