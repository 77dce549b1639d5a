"""Token ids in files compressed by Re-Pair, a grammar for each block of whole documents.

A block is a row of a Parquet table: ``shard, block, doc_ids, lengths, payload``.
``payload`` is, in little-endian order: the mark ``RPG3``; the numbers of rules and of
symbols and the first nonterminal (3 x uint32); each rule's left and right side
(2 x uint32); the number of ids each rule stands for (uint32); the low halves of the
symbols (uint16) and, unless all fit, their high halves (uint8, or uint16 if there are
2^24 symbols or more). No rule crosses the end of a document, so each document is a
range of symbols and is read without its neighbours.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.bpe_words import word_encoder
from newsloom.llm.words import mix, ranges
from newsloom.llm.workers import release, with_code
from newsloom.sources.staging import staging_path

MARK = b"RPG3"
BLOCK_IDS = 4 << 20
LEAST_USES = 12
_CELLS = 20
#: Turns in which a round settles overlaps; what is open then waits for the next round.
_TURNS = 4


def _frequent(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values found ``least`` times, in order, and how often."""
    ranked = np.sort(pairs)
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
    uses = np.diff(starts, append=len(ranked))
    often = uses >= least
    return ranked[starts[often]], uses[often]


def _found(kinds: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The place of each pair among the sorted kinds, or -1.

    Most are told by a table of cells, in which kinds that share a cell replace each other.
    """
    def cell(x: np.ndarray) -> np.ndarray:
        return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _CELLS)).view(np.int64)

    table = np.full(1 << _CELLS, -1, np.int32)
    table[cell(kinds)] = np.arange(len(kinds))
    shared = np.bincount(cell(kinds), minlength=1 << _CELLS) > 1
    cells = cell(pairs)
    place = table[cells]
    place[(place >= 0) & (kinds[place] != pairs)] = -1
    unsure = np.flatnonzero((place < 0) & shared[cells])
    if len(unsure):
        rank = np.minimum(np.searchsorted(kinds, pairs[unsure]), len(kinds) - 1)
        place[unsure] = np.where(kinds[rank] == pairs[unsure], rank, -1)
    return place


def re_pair(ids, lengths, base, least=LEAST_USES):
    """(left, right) sides of rules and the symbols, documents kept apart.

    Each round replaces all pairs of neighbours found ``least`` times: of pairs that
    overlap the more frequent one, and of a run of one symbol every second. A pair that
    this leaves with fewer uses waits for the next round. The most frequent pair always
    goes, so the rounds end when no pair is found ``least`` times, and only then.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(lengths) - 1] = True
    left, right, rules = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], 0
    # Whether a symbol and the next can be a frequent pair: one is new, or the pair was frequent before.
    fresh = np.ones(len(seq), bool)
    while len(seq) > 1:
        at = np.flatnonzero(fresh[:-1] & ~last[:-1])
        pairs = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
        kinds, uses = _frequent(pairs, least)
        if not len(kinds):
            break
        rank = np.empty(len(kinds), np.int64)
        rank[np.lexsort((mix(kinds), uses))] = np.arange(len(kinds))
        which = _found(kinds, pairs)
        del pairs
        some = np.flatnonzero(which >= 0)
        at, which = at[some], which[some]
        fresh = np.zeros(len(seq), bool)
        fresh[at] = True
        own, place = rank[which], np.arange(len(at))
        head = np.ones(len(at), bool)
        head[1:] = (np.diff(at) > 1) | (own[1:] != own[:-1])
        even = (place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0
        even = np.flatnonzero(even)
        at, which, own = at[even], which[even], own[even]
        apart = np.diff(at) > 1
        free, best = np.ones(len(at), bool), np.zeros(len(at), bool)
        for _ in range(_TURNS):
            wins = free.copy()
            wins[1:] &= apart | ~free[:-1] | (own[1:] > own[:-1])
            wins[:-1] &= apart | ~free[1:] | (own[:-1] > own[1:])
            best |= wins
            free &= ~wins
            free[1:] &= apart | ~wins[:-1]
            free[:-1] &= apart | ~wins[1:]
        taken = np.flatnonzero(best)
        used = np.bincount(which[taken], minlength=len(kinds))
        twins = kinds >> np.uint64(32) == kinds & np.uint64(0xFFFFFFFF)
        made = np.flatnonzero(used >= np.where(twins, (least + 1) // 2, least))
        symbol = np.zeros(len(kinds), np.uint32)
        symbol[made] = base + rules + np.arange(len(made), dtype=np.uint32)
        taken = taken[symbol[which[taken]] > 0]
        at, symbol = at[taken], symbol[which[taken]]
        left.append((kinds[made] >> np.uint64(32)).astype(np.uint32))
        right.append(kinds[made].astype(np.uint32))
        rules += len(made)
        seq[at] = symbol
        last[at] = last[at + 1]
        fresh[at] = True
        fresh[at[at > 0] - 1] = True
        # The symbol before may itself be the second half of a pair.
        second = np.zeros(len(seq), bool)
        second[at + 1] = True
        before = at[at > 1] - 1
        fresh[before[second[before]] - 1] = True
        stay = np.flatnonzero(~second)
        seq, last, fresh = seq[stay], last[stay], fresh[stay]
    return np.concatenate(left), np.concatenate(right), seq


def expansion_lengths(left: np.ndarray, right: np.ndarray, base: int) -> np.ndarray:
    lengths = np.ones(len(left), np.int64)
    for i, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        lengths[i] = (lengths[a - base] if a >= base else 1) + (lengths[b - base] if b >= base else 1)
    return lengths


def pack(ids: np.ndarray, lengths: np.ndarray, base: int) -> bytes:
    left, right, seq = re_pair(ids, lengths, base)
    head = np.array([len(left), len(seq), base], "<u4")
    spans = expansion_lengths(left, right, base).astype("<u4")
    sides = np.stack([left, right], 1).astype("<u4")
    return MARK + head.tobytes() + sides.tobytes() + spans.tobytes() + _halves(seq, base + len(left))


def _high_kind(kinds: int) -> str | None:
    return None if kinds <= 1 << 16 else "u1" if kinds <= 1 << 24 else "<u2"


def _halves(seq: np.ndarray, kinds: int) -> bytes:
    high = _high_kind(kinds)
    return seq.astype("<u2").tobytes() + ((seq >> np.uint32(16)).astype(high).tobytes() if high else b"")


class Block:
    """A payload: all its ids, or those of one stretch."""

    def __init__(self, payload: bytes):
        if payload[:4] != MARK:
            raise ValueError("not a token block")
        n, symbols, self.base = (int(x) for x in np.frombuffer(payload, "<u4", 3, 4))
        sides = np.frombuffer(payload, "<u4", 2 * n, 16).reshape(n, 2)
        self.spans = np.frombuffer(payload, "<u4", n, 16 + 8 * n).astype(np.int64)
        self.symbols = np.frombuffer(payload, "<u2", symbols, 16 + 12 * n).astype(np.int64)
        if high := _high_kind(self.base + n):
            self.symbols += np.frombuffer(payload, high, symbols, 16 + 12 * n + 2 * symbols).astype(np.int64) << 16
        self.at = np.cumsum(self.spans) - self.spans
        self.rules = np.zeros(int(self.spans.sum()), np.uint32)
        # A rule's sides are of lower depth, so all rules of one depth are spelt out together.
        sides = sides.astype(np.int64)
        for some in self._by_depth(sides):
            left, right = sides[some, 0], sides[some, 1]
            self._spell(left, self.at[some])
            middle = np.ones(len(some), np.int64)
            rule = left >= self.base
            middle[rule] = self.spans[left[rule] - self.base]
            self._spell(right, self.at[some] + middle)

    def _by_depth(self, sides: np.ndarray) -> Iterator[np.ndarray]:
        known = np.zeros(len(sides) + 1, bool)
        known[-1] = True  # stands for all ids
        of = np.where(sides >= self.base, sides - self.base, len(sides))
        waiting = np.arange(len(sides))
        while len(waiting):
            ready = known[of[waiting, 0]] & known[of[waiting, 1]]
            yield waiting[ready]
            known[waiting[ready]] = True
            waiting = waiting[~ready]

    def _spell(self, symbols: np.ndarray, to: np.ndarray) -> None:
        rule = symbols >= self.base
        self.rules[to[~rule]] = symbols[~rule]
        k = symbols[rule] - self.base
        self.rules[ranges(to[rule], self.spans[k])] = self.rules[ranges(self.at[k], self.spans[k])]

    def lengths(self) -> np.ndarray:
        rule = self.symbols >= self.base
        out = np.ones(len(self.symbols), np.int64)
        out[rule] = self.spans[self.symbols[rule] - self.base]
        return out

    def _expand(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        rule = symbols >= self.base
        table = np.concatenate([self.rules, symbols[~rule].astype(np.uint32)])
        starts = np.empty(len(symbols), np.int64)
        starts[rule] = self.at[symbols[rule] - self.base]
        starts[~rule] = len(self.rules) + np.arange(int((~rule).sum()))
        return table[ranges(starts, lengths)]

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols, self.lengths())

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the block; only symbols that reach into them are expanded."""
        lengths = self.lengths()
        ends = np.cumsum(lengths)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        part = self._expand(self.symbols[a:b], lengths[a:b])
        skip = start - (int(ends[a - 1]) if a else 0)
        return part[skip : skip + stop - start]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end: int = 0,
    block_ids: int = BLOCK_IDS,
    specials: bool = False,
) -> None:
    """Encode ``text`` of each row and write the blocks, in ascending order of ``doc_id``.

    Rows are dealt by ranges of (doc_id, hash of the text): NULL ids come first, and
    many rows with one id are spread as well. NULL text is the empty text, whose ids
    are ``end`` alone; equal rows are written each; an empty table gives a table of no
    blocks. A shard is one range; a block holds about ``block_ids`` ids, or one document.
    Special tokens that stand in a text are spelled out unless ``specials`` is set.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_encoder(tokenizer, specials)
        base = coder.tokenizer.get_vocab_size(with_added_tokens=True)
        shard = TaskContext.get().partitionId()
        block, held, names, sizes, total = 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.concatenate(sizes)
            payload = pack(np.concatenate(held), lengths, base)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([sum(names, [])], pa.list_(pa.int64())),
                    pa.array([lengths.astype(np.int64)], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary()),
                ],
                ["shard", "block", "doc_ids", "lengths", "payload"],
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, tokens, lengths in coder.encode(batch.column(1), end):
                held.append(tokens)
                sizes.append(lengths)
                names.append(ids[row : row + len(lengths)])
                total += len(tokens)
                if total >= block_ids:
                    yield flush()
                    block, held, names, sizes, total = block + 1, [], [], [], 0
                    release()
        if sizes:
            yield flush()
        held, names, sizes = [], [], []
        release()

    schema = "shard int, block int, doc_ids array<bigint>, lengths array<bigint>, payload binary"
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("__k"))
    ordered = keyed.repartitionByRange("doc_id", "__k").sortWithinPartitions("doc_id", "__k")
    with_code(ordered.select("doc_id", "text")).mapInArrow(encode, schema).write.parquet(path)


def read_token_files(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the blocks' payloads.

    ``start`` counts the ids of all documents before it in file order.
    """
    spark = blocks.sparkSession
    sized = blocks.select(
        "shard",
        "block",
        F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"),
    )
    # One number for each range of the sort that wrote the files.
    totals = sized.groupBy("shard").agg(F.sum("n")).collect()
    starts, before = [], 0
    for shard, n in sorted(tuple(r) for r in totals):
        starts.append((shard, before))
        before += n
    shards = spark.createDataFrame(starts, "shard int, __first bigint")
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sized.withColumn("__within", F.coalesce(F.sum("n").over(within), F.lit(0))).join(
        shards, "shard"
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, block, doc_ids, lengths, payload = (batch.column(k)[i] for k in range(5))
                lengths = lengths.values.to_numpy()
                ids = Block(payload.as_py()).ids().astype("<u4")
                ends = np.cumsum(lengths)
                view = memoryview(ids)
                crc = [zlib.crc32(view[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard.as_py(), np.int32)),
                        pa.array(np.full(n, block.as_py(), np.int32)),
                        doc_ids.values,
                        pa.array(ends - lengths),
                        pa.array(lengths),
                        pa.array(crc, pa.int64()),
                    ],
                    ["shard", "block", "doc_id", "__in_block", "n_tokens", "ids_crc32"],
                )

    rows = with_code(blocks.select("shard", "block", "doc_ids", "lengths", "payload")).mapInArrow(
        decode,
        "shard int, block int, doc_id bigint, __in_block bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return rows.join(offsets, ["shard", "block"]).select(
        "doc_id",
        (F.col("__first") + F.col("__within") + F.col("__in_block")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def token_files(docs: DataFrame, tokenizer: str, end: int = 0) -> DataFrame:
    """Write documents as token files below the staging folder and read every one back.

    The ids are those of the library as loaded: special tokens in a text are tokens.
    """
    spark = docs.sparkSession
    path = staging_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end, specials=True)
    return read_token_files(spark.read.parquet(path))
