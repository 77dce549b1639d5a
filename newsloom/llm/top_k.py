"""Exact top-k search by inner product: a dual-tree search over cover trees, in blocks.

Queries and data are indexed together: every vector is first put to the nearest of a few
pivots, rows are sorted by pivot inside their partition, and each run of neighbours
becomes a block with its own cover tree; the queries, a part of the rows, get trees of
their own in the same way. Blocks of queries are dealt to chunks and blocks of data
to strips; one task sees a chunk and a strip, holds the chunk's queries and their best
scores, and lets the strip's blocks go by. Pairs of nodes are pruned by their covering
radii against the worst k-th score in the query node. No task and no driver sees all rows.

Data is copied once for each chunk, and a chunk holds 128 MB of queries. Queries are copied
once for each strip; as one row in 50 is a query, 50 strips move as much as the data once.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm import cover_tree, vectors
from newsloom.llm.workers import release, with_code
from newsloom.sources.staging import stage

K = 5
EVERY = 50
PIVOTS = 256
STRIPS = 50
CHUNK_BYTES = 128 << 20

_INTS, _LONGS = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
_TREE = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("ids", _LONGS),
        T.StructField("points", _INTS),
        T.StructField("centers", _LONGS),
        T.StructField("radii", T.ArrayType(T.DoubleType())),
        T.StructField("first", _LONGS),
        T.StructField("last", _LONGS),
        T.StructField("kids", _LONGS),
        T.StructField("kids_end", _LONGS),
    ]
)
_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _nearest_pivot(pivots: np.ndarray):
    base = pivots.astype(np.float64)
    half = (base * base).sum(1) / 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = vectors.matrix(batch.column(1), base.shape[1]).astype(np.float64)
            cell = np.argmax(points @ base.T - half, axis=1) if len(points) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], ["id", "v", "cell"])

    return place


def _trees(dim: int, rows: int):
    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, n = [], 0

        def row(held) -> pa.RecordBatch:
            ids, points = (np.concatenate(part) for part in zip(*held))
            tree = cover_tree.build(ids, points)
            values = [number, tree.ids, tree.points.ravel(), *(getattr(tree, f.name) for f in _TREE.fields[3:])]
            arrays = [pa.array([number])]
            for field, value in zip(_TREE.fields[1:], values[1:]):
                kind = {"points": pa.int32(), "radii": pa.float64()}.get(field.name, pa.int64())
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), pa.array(value, kind)))
            return pa.RecordBatch.from_arrays(arrays, [f.name for f in _TREE.fields])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            points = vectors.matrix(batch.column(1), dim)
            at = 0
            while at < len(ids):
                step = min(rows - n, len(ids) - at)
                held.append((ids[at : at + step], points[at : at + step]))
                n, at = n + step, at + step
                if n == rows:
                    yield row(held)
                    held, n, number = [], 0, number + 1
        if held:
            yield row(held)
        release()

    return trees


def _tree(row: dict, dim: int) -> cover_tree.Tree:
    fields = {name: np.asarray(row[name].values) for name in row}
    fields["points"] = fields["points"].reshape(-1, dim)
    return cover_tree.Tree(**fields)


def _searched(dim: int, k: int):
    names = [f.name for f in _TREE.fields[1:]]

    def found(search: cover_tree.Search) -> Iterator[pa.RecordBatch]:
        for columns in search.results():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trees, search = None, [], None
        for batch in batches:
            at = {name: batch.column(batch.schema.get_field_index(name)) for name in ("chunk", "strip", "is_data", *names)}
            for i in range(batch.num_rows):
                here = (at["chunk"][i].as_py(), at["strip"][i].as_py())
                if here != group:
                    if search:
                        yield from found(search)
                    group, trees, search = here, [], None
                tree = _tree({name: at[name][i] for name in names}, dim)
                if not at["is_data"][i].as_py():
                    trees.append(tree)
                    continue
                search = search or cover_tree.Search(trees, k)
                search.visit(tree)
        if search:
            yield from found(search)
        release()

    return searched


def _indexed(rows: DataFrame, pivots: np.ndarray, block_rows: int) -> DataFrame:
    """Blocks of neighbours with their trees; rows stay in their partition."""
    placed = with_code(rows).mapInArrow(_nearest_pivot(pivots), "id bigint, v array<int>, cell int")
    ordered = placed.sortWithinPartitions("cell", "id").select("id", "v")
    return with_code(ordered).mapInArrow(_trees(pivots.shape[1], block_rows), _TREE)


def top_k(
    df: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    strips: int = STRIPS,
    chunk_bytes: int = CHUNK_BYTES,
    block_rows: int = cover_tree.BLOCK_ROWS,
) -> DataFrame:
    """The k greatest inner products of every query with the other rows.

    ``query_id, rank (from 1), vec_id, score``, ties to the smaller ``vec_id``; fewer than k
    rows if there are fewer candidates. Components x count as floor(256 x); a shorter vector
    counts as if zeros followed. Rows take no part if their id is NULL, or their vector is
    NULL or holds NULL or a number that is not finite. An id on several rows is one query, with
    the least of its vectors, never finds a row of its own id, and is found once for each of its rows by others.
    Other columns are not carried, so their names can't clash; an empty table gives an empty
    result. Products that may not fit 64 bits are an error.
    """
    spark = df.sparkSession
    usable = df.filter(F.col(id_col).isNotNull())
    kept = stage(
        vectors.whole_vectors(usable, vector, [F.col(id_col).cast("bigint").alias("id"), is_query.alias("asked")]), "whole-vectors"
    )
    longest, asked = kept.agg(F.max(F.size("v")), F.count_if("asked")).first()
    if not asked or not longest:
        # Vectors without components have the product 0.
        longest = 1
    pivots = vectors.matrix(
        pa.array([r.v for r in kept.orderBy(F.xxhash64("id"), "v").select("v").limit(PIVOTS).collect()], pa.list_(pa.int32())), longest
    )
    chunks = -(-max(asked, 1) * longest * 4 // chunk_bytes)
    data = _indexed(kept.select("id", "v"), pivots, block_rows)
    queries = kept.filter("asked").groupBy("id").agg(F.min("v").alias("v"))
    strips = min(strips, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = F.pmod(F.xxhash64("block"), F.lit(strips)).cast("int")
    chunk = F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int")
    asking = stage(_indexed(queries, pivots, block_rows), "query-trees").select("*", chunk.alias("chunk"), numbers(strips).alias("strip"))
    given = data.select("*", numbers(chunks).alias("chunk"), dealt.alias("strip"))
    both = asking.withColumn("is_data", F.lit(False)).unionByName(given.withColumn("is_data", F.lit(True)))
    side_by_side = both.repartition(strips * chunks, "chunk", "strip").sortWithinPartitions("chunk", "strip", "is_data", "block")
    found = with_code(side_by_side).mapInArrow(_searched(longest, k), _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


#: All products.
ORACLE_SQL = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
WHERE rank <= {K}"""
