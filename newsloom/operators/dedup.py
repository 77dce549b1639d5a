"""Order-respecting de-duplication on two keys, and against a store.

A row is kept iff no earlier *kept* row shares its id or its hash.  Seen as a
bipartite graph of ids and hashes this is the greedy maximal matching in row
order, which parallel rounds reach exactly: in each round the rows that are
first for both of their keys are kept, and the rows sharing a key with one of
them are decided.  On ordinary orders few rounds are needed (Blelloch, Fineman
and Shun, "Greedy sequential maximal independent set and matching are parallel
on average", 2012).

What is left after a few rounds are chains of conflicts.  A row with one earlier
neighbour only is kept iff that one is not, so along a run of such rows every second
one is kept: pointer jumping finds the start of each run, and the parity of the way
there, in a logarithmic number of joins.

All rounds run on the narrow table (scope, order, id, hash).
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.joins import HOT_ROWS, checked_broadcast, spread_join
from newsloom.sources.staging import row_count, same_rows, stage, stage_counted


#: Rounds before chains are contracted; contraction takes more joins than a round.
PLAIN_ROUNDS = 3


def kept_keys(
    keys: DataFrame,
    scope: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    plain_rounds: int = PLAIN_ROUNDS,
    trace: list[int] | None = None,
) -> DataFrame:
    """Kept rows (staged) of a narrow table with the columns ``*scope, ord, id, hash``.

    Rows of one ``ord`` are taken in the order of id and hash.  Of rows that agree in
    both keys only the first can be kept: what rejects it rejects the others, too.
    NULL keys are refused: they would never match, so no round could decide their
    rows.  ``trace`` takes the number of undecided rows before each round and of
    unfinished pointers before each jump.
    """
    scope = list(scope)
    triple = [*scope, "ord", "id", "hash"]
    trace = [] if trace is None else trace
    if not keys.filter(F.greatest(*map(F.isnull, triple))).isEmpty():
        raise ValueError("order, scope and both keys must not be NULL")
    once = keys.groupBy(*scope, "id", "hash").agg(F.min("ord").alias("ord"))
    undecided = stage_counted(once.withColumn("row", F.monotonically_increasing_id()), "keys")
    done, rounds = None, 0
    while True:
        trace.append(row_count(undecided))
        rounds += 1
        if rounds <= plain_rounds:
            kept, rest = stage(_firsts(undecided, scope).select(*triple), "kept"), undecided
        else:
            kept, rest = _contract(undecided, scope, hot_rows, trace)
        done = kept if done is None else done.unionByName(kept)
        for key in ("id", "hash"):
            on = [*scope, key]
            rest = spread_join(
                rest, kept.select(*on), on, "left_anti", ["ord"], undecided, hot_rows
            )
        undecided = stage_counted(rest, "undecided")
        if row_count(undecided) == 0:
            return done


def _firsts(rows: DataFrame, scope: list[str]) -> DataFrame:
    """Rows that are first for both of their keys."""
    by_id = rows.groupBy(*scope, "id").agg(F.min(F.struct("ord", "hash", "row")).alias("first"))
    by_hash = rows.groupBy(*scope, "hash").agg(F.min(F.struct("ord", "id", "row")).alias("first"))
    first_by_id = by_id.select(*scope, "first.ord", "id", "first.hash", "first.row")
    return first_by_id.join(by_hash.select("first.row"), "row")


def _contract(
    rows: DataFrame, scope: list[str], hot_rows: int, trace: list[int]
) -> tuple[DataFrame, DataFrame]:
    """Kept rows of all runs that start at a first row, and the rows that may still be undecided."""
    triple = [*scope, "ord", "id", "hash"]
    placed = rows
    for key, other in (("id", "hash"), ("hash", "id")):
        on = [*scope, key]
        first = rows.groupBy(*on).agg(F.min(F.struct("ord", other, "row"))["row"].alias(f"first_{key}"))
        placed = spread_join(placed, first, on, "left", ["row"], rows, hot_rows)
    placed = same_rows(stage(placed, "placed"), rows)
    runs, left = [], placed
    for key, other in (("id", "hash"), ("hash", "id")):
        on = [*scope, key]
        later = placed.filter(F.col(f"first_{key}") != F.col("row"))
        second = later.groupBy(*on).agg(
            F.min(F.struct("ord", other, "row", f"first_{key}", f"first_{other}")).alias("s")
        )
        # Second for one key and first for the other: one earlier neighbour.
        pair = stage(
            second.filter(F.col("s")["row"] == F.col("s")[f"first_{other}"]).select(
                *on, F.col("s")["row"].alias("second"), F.col("s")[f"first_{key}"].alias("first")
            ),
            "pairs",
        )
        runs.append(pair.select(F.col("second").alias("row"), F.col("first").alias("to")))
        # One row of such a pair is kept, so no third row of that key is.
        known = spread_join(left, pair, on, "left", ["row"], placed, hot_rows)
        left = known.filter(
            F.col("second").isNull() | F.col("row").isin(F.col("second"), F.col("first"))
        ).drop("second", "first")
    firsts = placed.filter((F.col("first_id") == F.col("row")) & (F.col("first_hash") == F.col("row")))
    starts = _run_starts(runs[0].unionByName(runs[1]), trace)
    even = spread_join(
        starts.filter(~F.col("odd")), firsts.select(F.col("row").alias("to")), ["to"], "left_semi", ["row"], hot_rows=hot_rows
    )
    names = firsts.select("row").unionByName(even.select("row"))
    kept = stage(placed.join(names, "row", "left_semi").select(*triple), "kept")
    return kept, left.drop("first_id", "first_hash")


def _run_starts(pointers: DataFrame, trace: list[int]) -> DataFrame:
    """The start of the run (``to``) that every pointer (row, to) belongs to, and whether the way is odd.

    Each jump doubles the length of the ways; finished pointers no longer move.
    """
    moving = stage_counted(pointers.withColumn("odd", F.lit(True)), "pointers")
    finished = moving.limit(0)
    while row_count(moving):
        trace.append(row_count(moving))
        ways = moving.withColumn("ended", F.lit(False)).unionByName(finished.withColumn("ended", F.lit(True)))
        ways = ways.select(F.col("row").alias("to"), F.col("to").alias("on_to"), F.col("odd").alias("on_odd"), "ended")
        jumped = stage(
            moving.join(ways, "to", "left").select(
                "row",
                F.coalesce("on_to", "to").alias("to"),
                (F.col("odd") != F.coalesce("on_odd", F.lit(False))).alias("odd"),
                F.coalesce("ended", F.lit(True)).alias("ended"),
            ),
            "jumped",
        )
        finished = finished.unionByName(jumped.filter("ended").drop("ended"))
        moving = stage_counted(jumped.filter("NOT ended").drop("ended"), "pointers")
    return same_rows(finished, pointers)


def _narrow(df, order, id_col, hash_col, scope):
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.select(
        *scope,
        position.alias("ord"),
        F.col(id_col).alias("id"),
        F.col(hash_col).alias("hash"),
    )


def dedup_two_key(
    df: DataFrame,
    order: str | Sequence[str],
    id_col: str = "id_article",
    hash_col: str = "content_hash",
    scope: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of ``df`` kept by the two-key rule, keys looked at per ``scope``.

    Rows that agree in order and both keys count once, and one of them is kept.
    ``df`` is read twice (keys first, then the kept rows), so pass a staged
    table if it is costly.
    """
    order = [order] if isinstance(order, str) else list(order)
    scope = list(scope)
    narrow = _narrow(df, order, id_col, hash_col, scope)
    kept = kept_keys(narrow, scope, hot_rows)
    position = (
        [F.col("ord").alias(order[0])]
        if len(order) == 1
        else [F.col("ord")[c].alias(c) for c in order]
    )
    names = kept.select(*scope, *position, F.col("id").alias(id_col), F.col("hash").alias(hash_col))
    return one_of_equals(df, names)


def one_of_equals(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` named by ``names``, whose rows are distinct; of several rows with one name, one."""
    found = rows.join(names, names.columns, "left_semi")
    repeated = found.groupBy(*names.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if repeated.isEmpty():
        return found
    again = stage(repeated.drop("_n"), "repeated")
    once = found.join(again, names.columns, "left_semi").dropDuplicates(names.columns)
    return found.join(again, names.columns, "left_anti").unionByName(once)


def dedup_outcomes(
    keys: DataFrame,
    kept: DataFrame,
    scope: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Label each row of a narrow table: accepted, dup_id or dup_hash.

    A rejected row is a ``dup_id`` if an earlier kept row has its id, else a
    ``dup_hash``.  ``keys`` and ``kept`` should be staged.
    """
    scope = list(scope)
    owners = kept.select(*scope, "id", F.col("ord").alias("_owner"))
    labelled = spread_join(keys, owners, [*scope, "id"], "left", ["ord"], hot_rows=hot_rows)
    triple = [*scope, "ord", "id", "hash"]
    marked = labelled.join(kept.select(*triple, F.lit(True).alias("_kept")), triple, "left")
    outcome = (
        F.when(F.col("_kept"), "accepted")
        .when(F.col("_owner") <= F.col("ord"), "dup_id")
        .otherwise("dup_hash")
    )
    return marked.withColumn("outcome", outcome).drop("_owner", "_kept")


def without_stored(
    rows: DataFrame,
    stored: DataFrame,
    key: str,
    scope: Sequence[str] = (),
    spread_by: str = "ord",
    hot_rows: int = HOT_ROWS,
    base: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key is not among the stored keys.

    The store is first reduced to the keys that occur in the batch: a batch of
    checked size is broadcast, so that a large store is read but not shuffled.
    NULL stored keys never match.  ``base`` (default: ``rows``) is a staged
    table that contains ``rows``; sizes and key statistics are taken from it.
    """
    on = [*scope, key]
    base = rows if base is None else base
    wanted = checked_broadcast(base.select(*on).distinct(), base)
    hits = stored.select(*on).dropna(subset=[key]).join(wanted, on, "left_semi")
    return spread_join(rows, hits, on, "left_anti", [spread_by], base, hot_rows)


def without_hits(
    rows: DataFrame,
    hits: DataFrame,
    kind: str,
    key: str,
    scope: Sequence[str] = (),
    spread_by: str = "ord",
    hot_rows: int = HOT_ROWS,
    base: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``key`` is not among the ``hits`` (``*scope, kind, key``) of its kind."""
    on = [*scope, key]
    gone = hits.filter(F.col("kind") == kind).select(*scope, F.col("key").alias(key))
    return spread_join(rows, gone, on, "left_anti", [spread_by], rows if base is None else base, hot_rows)


def drop_stored(
    articles: DataFrame,
    store: DataFrame,
    scope: Sequence[str] = (),
    spread_by: str = "entry_ord",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Articles whose id and content hash are both new to the store.

    A legacy store without ``content_hash`` contributes no content keys.
    ``articles`` should be staged.
    """
    fresh = articles
    for key in ("id_article", "content_hash"):
        if key in store.columns:
            fresh = without_stored(fresh, store, key, scope, spread_by, hot_rows, articles)
    return fresh
