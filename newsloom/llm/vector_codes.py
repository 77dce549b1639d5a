"""Product codes of vectors, their entries found by Orchard's search.

Vectors of whole numbers are cut into equal parts, and each part position has a codebook
of up to 64 entries. Orchard's search finds the nearest entry exactly: every entry keeps
the others sorted by their distance from it; a search walks along the list of its current
best entry, jumps to the list of any better one, passes over entries that it has measured
already, and stops at the first entry beyond twice its current distance. By the triangle
inequality no entry from there on can be as near.

The rounds are Spark jobs over a written table of whole-number vectors: tasks hand back
sums and counts for each entry, so only parts x entries rows leave them.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import vectors
from newsloom.llm.workers import release, with_code
from newsloom.operators.joins import spread_join
from newsloom.sources.staging import stage, stage_counted

PARTS = 16
ENTRIES = 64
ROUNDS = 2
_SLICE = 4096


class Orchard:
    """Nearest entry of a codebook (entries x width, whole numbers) by squared distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        n = len(entries)
        gaps = ((self.entries[:, None, :] - self.entries[None, :, :]) ** 2).sum(2)
        order = np.argsort(gaps, axis=1, kind="stable")
        # An entry is not on its own list.
        self.lists = order[order != np.arange(n)[:, None]].reshape(n, n - 1)
        self.gaps = np.take_along_axis(gaps, self.lists, 1)
        self.measured = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index (the lowest of several) and squared distance for each point."""
        found = [self._search(points[i : i + _SLICE].astype(np.int64)) for i in range(0, len(points), _SLICE)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def _search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, most = len(points), self.lists.shape[1]
        best = np.zeros(n, np.int64)
        distance = ((points - self.entries[0]) ** 2).sum(1)
        seen = np.zeros((n, len(self.entries)), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        self.measured += n
        active = np.arange(n) if most else np.zeros(0, np.int64)
        while len(active):
            current, at = best[active], place[active]
            entry = self.lists[current, at]
            near = self.gaps[current, at] <= 4 * distance[active]
            active, entry = active[near], entry[near]
            place[active] += 1
            new = ~seen[active, entry]
            who, entry = active[new], entry[new]
            seen[who, entry] = True
            self.measured += len(who)
            d = ((points[who] - self.entries[entry]) ** 2).sum(1)
            better = (d < distance[who]) | ((d == distance[who]) & (entry < best[who]))
            who, entry = who[better], entry[better]
            best[who], distance[who], place[who] = entry, d[better], 0
            active = active[place[active] < most]
        return best, distance


def codebook_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, as decimal numbers with commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _parts(batch: pa.RecordBatch, books: np.ndarray) -> np.ndarray:
    """Vectors as (parts, rows, width)."""
    parts, _, width = books.shape
    rows = vectors.matrix(batch.column(batch.schema.get_field_index("v")), parts * width)
    return rows.reshape(len(rows), parts, width).transpose(1, 0, 2)


_SUMS = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("entry", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("sums", T.ArrayType(T.LongType())),
    ]
)


def _summed(books: np.ndarray):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        search = [Orchard(book) for book in books]
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for p, points in enumerate(_parts(batch, books)):
                code, _ = search[p].nearest(points)
                n[p] += np.bincount(code, minlength=entries)
                for j in range(width):
                    # Whole numbers of 32 bits times the rows of a batch stay exact in a double.
                    total[p, :, j] += np.bincount(code, points[:, j], entries).astype(np.int64)
        used_p, used_e = np.nonzero(n)
        flat = pa.array(total[used_p, used_e].ravel())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used_p, pa.int32()),
                pa.array(used_e, pa.int32()),
                pa.array(n[used_p, used_e]),
                pa.ListArray.from_arrays(pa.array(np.arange(len(used_p) + 1) * width, pa.int32()), flat),
            ],
            [f.name for f in _SUMS.fields],
        )
        release()

    return sums


def _coded(books: np.ndarray):
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = [Orchard(book) for book in books]
        for batch in batches:
            code = np.zeros((batch.num_rows, len(books)), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for p, points in enumerate(_parts(batch, books)):
                code[:, p], distance = search[p].nearest(points)
                error += distance
            digits = code.tobytes().hex()
            size = 2 * len(books)
            names = [name for name in batch.schema.names if name != "v"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(name)) for name in names),
                    pa.array([digits[i : i + size] for i in range(0, len(digits), size)], pa.string()),
                    pa.array(error),
                ],
                [*names, "code", "error"],
            )
        release()

    return codes


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors (``id, label, code, error``) and the codebooks.

    The codebooks start as the parts of the ``entries`` vectors with the smallest ids (then
    the smallest vectors; of fewer vectors, all) and are moved ``rounds`` times to the means,
    rounded down, of the parts nearest to them; unused entries stay. ``code`` has two hex
    digits for each part, ``error`` is the sum of the squared distances. Vectors that are NULL or
    hold NULL or a number that is not finite go. If vectors differ in length or can't be cut
    evenly, zeros are added up to the next length that can. Repeated rows are coded each; a
    NULL id or label stays and is the last to be taken for a codebook. Other columns are
    not carried. Without usable vectors the result is empty and the codebooks are, too.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: 256 entries at most")
    kept = stage(vectors.whole_vectors(df, vector, [F.col(id_col).alias("id"), F.col(label).alias("label")]), "whole-vectors")
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    schema = T.StructType([*kept.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if longest is None:
        return kept.sparkSession.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64)
    width = max(1, -(-longest // parts))
    first = kept.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.zeros((len(first), parts * width), np.int64)
    for row, at in zip(first, books):
        at[: len(row.v)] = row.v
    books = np.ascontiguousarray(books.reshape(len(first), parts, width).transpose(1, 0, 2))
    for _ in range(rounds):
        sums = with_code(kept.select("v")).mapInArrow(_summed(books), _SUMS)
        totals = sums.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums")
        )
        books = books.copy()
        for row in totals.collect():  # parts x entries at most
            books[row.part, row.entry] = [x // row.n for x in row.sums]
    return with_code(kept).mapInArrow(_coded(books), schema), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with the same label, NULL being a label, too."""
    rows = stage_counted(
        coded.select("*", F.col("label").isNull().alias("_none"), F.coalesce("label", F.lit(0)).alias("_label")), "codes"
    )
    sums = rows.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"))
    return spread_join(rows, sums, ["_none", "_label"], "left", ["id"]).drop("_none", "_label")


def code_report(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Code, error, the label's error and a digest of the codebooks for every usable vector."""
    coded, books = compress(df, id_col, vector, label)
    return with_label_errors(coded).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256")
    )


def _round_sql(i: int, final: bool = False) -> str:
    moved = "" if final else f""",
book{i + 1} AS (
  SELECT b.part, b.entry, b.j, CASE WHEN s.n IS NULL THEN b.x ELSE (s.total - ((s.total % s.n) + s.n) % s.n) // s.n END AS x
  FROM book{i} b LEFT JOIN (
    SELECT code{i}.part, code{i}.entry, j, count(*) AS n, sum(x)::BIGINT AS total FROM code{i} JOIN cells USING (r, part)
    GROUP BY ALL) s USING (part, entry, j))"""
    return f""",
code{i} AS (
  SELECT r, part, entry, d FROM (
    SELECT c.r, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS d
    FROM cells c JOIN book{i} b USING (part, j) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1){moved}"""


#: All distances, for vectors of one length that 16 divides.
ORACLE_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (
  SELECT r, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS j, v[i] AS x
  FROM (SELECT r, v, unnest(range(1, len(v) + 1)) AS i FROM kept)),
book0 AS (SELECT part, r - 1 AS entry, j, x FROM cells WHERE r <= {ENTRIES}){"".join(_round_sql(i) for i in range(ROUNDS))}{_round_sql(ROUNDS, True)},
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM code{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, j)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (r)"""
