"""Benchmark leaks in documents: items found by edit distance, and documents without them."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.edit_lsh import Index
from newsloom.llm.words import slices, span_hashes, spans, word_bytes
from newsloom.llm.workers import release, with_code

#: Share of an item's words that may be inserted, deleted or replaced.
EDIT_SHARE = 0.1
#: Share of items, edited as much as allowed, that the keys must bring up.
TARGET_RECALL = 0.97
#: Items searched for in one pass over the documents.
ITEMS_PER_BLOCK = 20_000

_LEAK = pa.struct(
    [
        ("item_id", pa.int64()),
        ("start_byte", pa.int64()),
        ("end_byte", pa.int64()),
        ("edits", pa.int64()),
    ]
)
_LEAKS = "array<struct<item_id: bigint, start_byte: bigint, end_byte: bigint, edits: bigint>>"


def _words(data: np.ndarray, offsets: np.ndarray):
    starts, ends = spans(data, offsets, word_bytes(False))
    return span_hashes(data, starts, ends, lower=True), starts, ends, np.searchsorted(starts, offsets)


def build_index(texts: list[str | None], share: float = EDIT_SHARE, target: float = TARGET_RECALL) -> Index:
    """Items without words are kept in place and never found."""
    items: list[np.ndarray] = []
    for _, data, offsets in slices(pa.array(texts, pa.string())):
        words, _, _, at = _words(data, offsets)
        items += [words[a:b] for a, b in zip(at[:-1], at[1:])]
    return Index(items, share, target)


def leaks_of(index: Index, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """Row: (item's place, first byte, byte behind the last, edits), for rows of a slice that have any."""
    words, starts, ends, at = _words(data, offsets)
    # One word that no text has, between rows.
    joined = np.insert(words, at[1:-1], np.uint64(0))
    first = at[:-1] + np.arange(len(offsets) - 1)
    pairs = list(index.candidates(joined))
    if not pairs:
        return {}
    item = np.concatenate([p[0] for p in pairs])
    start = np.concatenate([p[1] for p in pairs])
    order = np.lexsort((start, item))
    item, start = item[order], start[order]
    size = np.array([len(x) for x in index.items])[item]
    row = np.maximum(np.searchsorted(first, np.minimum(start + size // 2, len(joined) - 1), "right") - 1, 0)
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (start[1:] - start[:-1] > size[1:] // 2)
    begins = np.flatnonzero(new)
    ends_at = np.append(begins[1:], len(item)) - 1
    items, rows = item[begins], row[begins]
    lengths, edits = size[begins], np.array(index.edits)[items]
    slack = 4 + 3 * edits
    low = np.maximum(start[begins] - slack - first[rows], 0) + at[rows]
    high = np.minimum(start[ends_at] + lengths + slack - first[rows] + at[rows], at[rows + 1])
    # A stretch within the distance has nearly all words of its item.
    stand = np.flatnonzero(high > low)
    stand = stand[index.shared(items[stand], words, low[stand], high[stand]) >= (lengths - edits)[stand]]
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    for k in stand.tolist():
        i, r, base = int(items[k]), int(rows[k]), int(low[k])
        for s, e, n in index.occurrences(i, words[base : int(high[k])]):
            if e > s:
                x, y = starts[base + s] - offsets[r], ends[base + e - 1] - offsets[r]
                found.setdefault(r, []).append((i, int(x), int(y), n))
    return {r: sorted(set(x), key=lambda v: (v[1], v[0], v[2])) for r, x in found.items()}


def mark_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    share: float = EDIT_SHARE,
    target: float = TARGET_RECALL,
    block: int = ITEMS_PER_BLOCK,
) -> DataFrame:
    """``docs`` with ``leaks``: item_id, byte range in the text and edits of each item found.

    Words are lower-cased and split at white space and ASCII signs. ``items`` has
    ``item_id, text``; those of fewer than five words cannot be told from chance and are
    passed over, as are NULL texts. Items come to the driver in blocks of about ``block``
    and each block passes once over all documents. Candidates come from the keys alone,
    whose recall is measured while they are made; each is then verified exactly, so that
    nothing is reported beyond the edit distance. NULL and empty texts have no leaks;
    equal items are each reported; a column named leaks is replaced.
    """
    n = items.count()
    blocks = max(1, -(-n // block))
    columns = [c for c in docs.columns if c != "leaks"]
    at = columns.index(text)
    part_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    marked = docs.select(*columns, F.expr(f"CAST(array() AS {_LEAKS})").alias("leaks"))
    for number in range(blocks):
        rows = items.filter(part_of == number).select("item_id", "text").collect()
        rows.sort(key=lambda r: (r[0] is None, r[0], r[1] or ""))
        index = build_index([r[1] for r in rows], share, target)
        marked = _with_block(marked, columns, at, index, [r[0] for r in rows])
    return marked


def _with_block(docs: DataFrame, columns: list[str], at: int, index: Index, ids: list[int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column(at)):
                part = batch.slice(row, len(offsets) - 1)
                found = leaks_of(index, data, offsets)
                lists = part.column(len(columns)).to_pylist()
                for r, leaks in found.items():
                    lists[r] = lists[r] + [
                        {"item_id": ids[i], "start_byte": x, "end_byte": y, "edits": e} for i, x, y, e in leaks
                    ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(lists, pa.list_(_LEAK))], [*columns, "leaks"]
                )
        release()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "leaks"]
    return with_code(docs).mapInArrow(run, ", ".join([*fields, f"leaks {_LEAKS}"]))


def find_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row for each leak: ``doc_id, item_id, start_byte, end_byte, edits``."""
    marked = mark_leaks(docs.select("doc_id", "text"), items, **options)
    return marked.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that have a leak."""
    return mark_leaks(docs, items, **options).filter(F.size("leaks") == 0).select(docs.columns)
