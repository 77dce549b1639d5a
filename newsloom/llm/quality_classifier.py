"""Quality by ordinal regression: one weight for each hashed feature, ordered thresholds for the grades."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.words import hashed_words, mix, slices
from newsloom.llm.workers import release, with_code
from newsloom.sources.staging import stage

#: At most so many labelled rows are fitted on.
FIT_ROWS = 20_000
#: A document is kept if the probability of the best grade is at least this.
LEAST_TAIL = 0.35
#: Features found in fewer fitted rows, or less tied to the grade, get no weight.
LEAST_ROWS = 8
LEAST_Z = 4.5
GRADES = 3

_SHARES = ((0x41, 0x5B), (0x30, 0x3A))  # capitals, digits
_FEATURE = np.uint64((1 << 62) - 1)


def _classes() -> np.ndarray:
    """Per byte: capital, digit, sign, blank."""
    table = np.zeros((256, 4), np.uint8)
    for k, (a, b) in enumerate(_SHARES):
        table[a:b, k] = 1
    for b in range(0x21, 0x7F):
        table[b, 2] = not chr(b).isalnum()
    table[[0x20, 9, 10, 11, 12, 13], 3] = 1
    return table


_CLASSES = _classes()


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    upto = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=upto[1:], dtype=np.int64)
    return upto[offsets[1:]] - upto[offsets[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of a slice: its lower-cased words and, in steps, what its letters look like.

    Words are split at white space and ASCII signs. A row may name a feature more than once.
    """
    words, at = hashed_words(data, offsets, lower=True, punctuation=False)
    n = len(offsets) - 1
    counts = np.diff(at)
    rows = [np.repeat(np.arange(n), counts)]
    found = [words & _FEATURE]
    length = np.diff(offsets)
    sums = np.zeros((4, n), np.int64)
    for k in range(4):
        sums[k] = _sums(_CLASSES[:, k][data], offsets)
    solid = np.maximum(length - sums[3], 1)
    steps = [
        40 * sums[0] // solid,
        40 * sums[1] // solid,
        40 * sums[2] // solid,
        2 * solid // np.maximum(counts, 1),
        np.log2(counts + 1.0).astype(np.int64),
        40 * _sums(np.append(False, words[1:] == words[:-1])[: len(words)], at) // np.maximum(counts, 1),
    ]
    for kind, step in enumerate(steps):
        rows.append(np.arange(n))
        key = (np.minimum(step, 20) + 1000 * (kind + 1)).astype(np.uint64)
        found.append(mix(key) & _FEATURE)
    return np.concatenate(rows), np.concatenate(found)


def distinct(rows: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    return rows[new], found[new]


@dataclass
class Ordinal:
    """P(grade > k) = 1 / (1 + exp(thresholds[k] - score)), the score being the sum of a row's weights."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, n: int, rows: np.ndarray, found: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(n)
        maybe = np.zeros(1 << 16, bool)
        maybe[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        near = maybe[(found & np.uint64(0xFFFF)).astype(np.int64)]
        rows, found = rows[near], found[near]
        place = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        hit = self.keys[place] == found
        rows, place = distinct(rows[hit], place[hit])
        return np.bincount(rows, self.weights[place], n)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > 0), P(grade > 1) ... of each row."""
        return _logistic(scores[:, None] - self.thresholds)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def screened(rows: np.ndarray, found: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Features whose rows' grades differ from the rest by more than chance."""
    keys, which, uses = np.unique(found, return_inverse=True, return_counts=True)
    n = len(grades)
    strength = np.zeros(len(keys))
    for k in range(1, GRADES):
        above = (grades >= k).astype(float)
        share = above.mean()
        if 0 < share < 1:
            expected = uses * share
            spread = np.sqrt(np.maximum(uses * share * (1 - share) * (1 - uses / n), 1e-9))
            z = (np.bincount(which, above[rows], len(keys)) - expected) / spread
            strength = np.maximum(strength, np.abs(z))
    return keys[(uses >= LEAST_ROWS) & (strength > LEAST_Z)]


def fit(rows: np.ndarray, found: np.ndarray, grades: np.ndarray, steps: int = 400, decay: float = 2e-4) -> Ordinal:
    """Maximum likelihood with a small squared penalty, by Adam over all rows at once.

    Thresholds stay in order: their gaps are exponentials. Without rows or with a single
    grade no feature has a weight, and the thresholds follow the grades' shares. A row
    names a feature once.
    """
    n = len(grades)
    keys = screened(rows, found, grades) if n else np.zeros(0, np.uint64)
    inside = np.isin(found, keys)
    rows, place = rows[inside], np.searchsorted(keys, found[inside])
    tail = np.array([((grades > k).sum() + 1) / (n + 2) for k in range(GRADES - 1)])
    first = -np.log(tail / (1 - tail))
    gaps = np.log(np.maximum(np.diff(first), 0.05))
    free = np.concatenate([np.zeros(len(keys)), first[:1], gaps])
    mean, square = np.zeros_like(free), np.zeros_like(free)
    w = len(keys)

    def thresholds(free: np.ndarray) -> np.ndarray:
        return free[w] + np.concatenate([[0], np.cumsum(np.exp(free[w + 1 :]))])

    for step in range(1, steps + 1 if n and w else 1):
        theta = thresholds(free)
        above = _logistic(np.bincount(rows, free[:w][place], n)[:, None] - theta)
        edges = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        at = np.arange(n)
        upper, lower = edges[at, grades], edges[at, grades + 1]
        p = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / p, lower * (1 - lower) / p
        by_score = (slope_up - slope_low) / n
        by_theta = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            by_theta[k] = (slope_low[grades == k].sum() - slope_up[grades == k + 1].sum()) / n
        grad = np.zeros_like(free)
        grad[:w] = np.bincount(place, by_score[rows], w) - decay * free[:w]
        grad[w] = by_theta.sum()
        for k in range(1, GRADES - 1):
            grad[w + k] = by_theta[k:].sum() * np.exp(free[w + k])
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (steps + 1)))
        free = free + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return Ordinal(keys, free[:w], thresholds(free))


def grade_of(quality: Column, toxic: Column) -> Column:
    """0: toxic, 1: of low quality, 2: good; NULL if either label is missing."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic == 1, 0).when(quality == 1, 2).otherwise(1)


def train(docs: DataFrame, grades: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS) -> Ordinal:
    """Fit on ``grades`` (doc_id, grade), at most ``fit_rows`` of them, chosen by a hash of doc_id.

    Features are found and screened where the documents are; the driver gets those that pass.
    Of several texts of one doc_id the least counts, NULL if there is no other.
    """
    chosen = (
        grades.filter("grade IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.min("grade").cast("bigint").alias("__grade"))
        .orderBy(F.xxhash64("__id"))
        .limit(fit_rows)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column(2)):
                n = len(offsets) - 1
                rows, found = distinct(*features(data, offsets))
                at = np.searchsorted(rows, np.arange(n + 1))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), batch.column(1).slice(row, n), lists],
                    ["__id", "__grade", "found"],
                )
        release()

    # At most fit_rows rows of two numbers.
    own = docs.select("doc_id", F.col(text).alias("__text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("__id")
    )
    once = own.groupBy("__id", "__grade").agg(F.min("__text").alias("__text"))
    found = stage(with_code(once).mapInArrow(extract, "__id bigint, __grade bigint, found array<bigint>"), "features")
    known = [tuple(r) for r in found.select("__id", "__grade").collect()]  # fit_rows at most
    known.sort()
    graded = np.array([g for _, g in known], np.int64)
    pairs = found.select("__id", "__grade", F.explode("found").alias("f"))
    telling = _telling(pairs, graded)
    # Only features that tell grades apart come to the driver.
    table = pairs.join(telling, "f", "left_semi").select("__id", "f").toArrow()
    rows = np.searchsorted(np.array([i for i, _ in known], np.int64), table.column("__id").to_numpy())
    values = table.column("f").to_numpy().view(np.uint64)
    del table
    model = fit(rows, values, graded)
    release()
    return model


def _telling(pairs: DataFrame, grades: np.ndarray) -> DataFrame:
    """As `screened`, of a table of (row, grade, f): counted where the rows are."""
    n, strong = len(grades), F.lit(False)
    uses = F.col("uses")
    counts = [F.count_if(F.col("__grade") >= k).alias(f"above_{k}") for k in range(1, GRADES)]
    for k in range(1, GRADES):
        share = float((grades >= k).mean()) if n else 0.0
        if 0 < share < 1:
            spread = F.sqrt(F.greatest(uses * (share * (1 - share)) * (1 - uses / n), F.lit(1e-9)))
            # A little less than the threshold: `fit` screens again, in its own arithmetic.
            strong |= F.abs(F.col(f"above_{k}") - uses * share) / spread > LEAST_Z * (1 - 1e-9)
    counted = pairs.groupBy("f").agg(F.count("*").alias("uses"), *counts)
    return counted.filter((uses >= LEAST_ROWS) & strong).select("f")


_ADDED = ("expected_grade", "p_good", "kept")


def classify(docs: DataFrame, model: Ordinal, text: str = "text", least_tail: float = LEAST_TAIL) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_good`` (probability of the best grade) and ``kept``.

    NULL is judged like the empty text, by its length alone. Equal texts are judged
    alike, rows do not influence each other, and columns of the added names are replaced.
    """
    columns = [c for c in docs.columns if c not in _ADDED]
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column(at)):
                n = len(offsets) - 1
                tails = model.tails(model.scores(n, *features(data, offsets)))
                part = batch.slice(row, n)
                added = [pa.array(tails.sum(1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= least_tail)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*columns, *_ADDED])
        release()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]
    return with_code(docs.select(*columns)).mapInArrow(
        run, ", ".join([*fields, "expected_grade double, p_good double, kept boolean"])
    )


def rate_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Train on the labels of ``docs`` and classify all of ``docs``."""
    grades = labels.select("doc_id", grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    return classify(docs, train(docs, grades, fit_rows=fit_rows))
