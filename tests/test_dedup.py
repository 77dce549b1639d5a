import random

import pytest
from pyspark.sql import functions as F

from newsloom import dedup_two_key, drop_stored
from newsloom.operators.dedup import dedup_outcomes, kept_keys
from newsloom.operators.joins import hot_keys, spread_join
from newsloom.operators.membership import likely_members
from newsloom.sources.staging import stage

KEYS = "ord bigint, id string, hash string"


def sequential(rows):
    """The rule as a loop: (order, id, hash) -> kept orders."""
    ids, hashes, kept = set(), set(), []
    for order, key, content in sorted(rows):
        if key not in ids and content not in hashes:
            ids.add(key)
            hashes.add(content)
            kept.append(order)
    return kept


def kept(spark, rows, **options):
    df = kept_keys(spark.createDataFrame(rows, KEYS), **options)
    return sorted(r.ord for r in df.collect())


CASES = [
    ([(1, "a", "x"), (2, "a", "y"), (3, "b", "y")], [1, 3]),
    ([(1, "a", "x"), (2, "b", "x"), (3, "b", "y")], [1, 3]),
    ([(1, "a", "x"), (2, "a", "y"), (3, "b", "y"), (4, "b", "z")], [1, 3]),
    ([], []),
]


@pytest.mark.parametrize("rows, want", CASES)
def test_cases(spark, rows, want):
    assert kept(spark, rows) == want


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"i{rng.randrange(60)}", f"h{rng.randrange(60)}") for i in range(150)]
    rng.shuffle(rows)
    assert kept(spark, rows) == sequential(rows)
    # Rounds only, and with every key treated as a hot one.
    assert kept(spark, rows, hot_rows=1) == sequential(rows)


def test_one_key_on_a_third_of_all_rows(spark):
    rng = random.Random(7)
    rows = [
        (i, f"i{i}" if i % 3 else f"i{rng.randrange(50)}", "hot" if i % 3 == 1 else f"h{rng.randrange(400)}")
        for i in range(900)
    ]
    assert kept(spark, rows, hot_rows=20) == sequential(rows)


def test_long_chain_of_conflicts(spark):
    chain = [(i, f"i{(i + 1) // 2}", f"h{i // 2}") for i in range(12)]
    assert kept(spark, chain) == sequential(chain)
    # In mixed order a long chain takes few rounds.
    places = list(range(400))
    random.Random(2).shuffle(places)
    long = [(places[i], f"i{(i + 1) // 2}", f"h{i // 2}") for i in range(400)]
    assert kept(spark, long) == sequential(long)


@pytest.mark.parametrize("size, plain_rounds, hot_rows", [(30, 0, 5), (60, 1, 10_000), (140, 0, 10_000)])
def test_contraction_equals_the_sequential_rule(spark, size, plain_rounds, hot_rows):
    rng = random.Random(size)
    rows = [(i, f"i{rng.randrange(size)}", f"h{rng.randrange(size)}") for i in range(150)]
    # Chains beside and through the rest, in order and against it.
    rows += [(200 + i, f"i{300 + (i + 1) // 2}", f"h{300 + i // 2}") for i in range(25)]
    rows += [(300 - i, f"i{400 + (i + 1) // 2}", f"h{400 + i // 2}") for i in range(26)]
    rows += [(500 + 3 * i, f"i{300 + i}", f"h{i}") for i in range(10)]
    rng.shuffle(rows)
    assert kept(spark, rows, plain_rounds=plain_rounds, hot_rows=hot_rows) == sequential(rows)


def test_a_chain_of_100000_rows_takes_few_rounds(spark):
    n = 100_000
    i = F.col("id")
    chain = spark.range(n).select(
        i.alias("ord"),
        F.concat(F.lit("i"), F.floor((i + 1) / 2)).alias("id"),
        F.concat(F.lit("h"), F.floor(i / 2)).alias("hash"),
    )
    trace = []
    got = kept_keys(chain, trace=trace)
    # Every second row, in three plain rounds, one contraction and 17 jumps at most.
    assert got.count() == n // 2
    assert got.filter("ord % 2 = 1").isEmpty()
    assert len(trace) <= 3 + 1 + 18


def test_repeated_positions_and_rows(spark):
    rows = [(1, "b", "y"), (1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (2, "c", "z"), (2, "c", "z")]
    df = kept_keys(spark.createDataFrame(rows, KEYS))
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a", "x"), (1, "b", "y"), (2, "c", "z")]
    wide = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], KEYS + ", n int")
    got = dedup_two_key(wide, "ord", "id", "hash")
    assert sorted((r.ord, r.id, r.hash) for r in got.collect()) == [(1, "a", "x"), (1, "b", "y"), (2, "c", "z")]


@pytest.mark.parametrize("row", [(1, None, "x"), (1, "a", None), (None, "a", "x")])
def test_null_keys_are_refused(spark, row):
    with pytest.raises(ValueError):
        kept(spark, [row, (2, "b", "y")])


def test_scope_and_column_orders(spark):
    rows = [("p", 0, 1, "a", "x"), ("q", 0, 1, "a", "x"), ("q", 1, 0, "a", "z"), ("p", 0, 0, "b", "x")]
    df = spark.createDataFrame(
        rows, "profile string, feed_ord int, entry_ord bigint, id_article string, content_hash string"
    )
    got = dedup_two_key(df, ["feed_ord", "entry_ord"], scope=["profile"]).collect()
    assert sorted(tuple(r)[:3] for r in got) == [("p", 0, 0), ("q", 0, 1)]


def test_outcomes(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, "b", "y"), (5, "b", "y"), (6, "c", "x")]
    keys = stage(spark.createDataFrame(rows, KEYS), "keys")
    won = stage(kept_keys(keys), "won")
    got = {r.ord: r.outcome for r in dedup_outcomes(keys, won, hot_rows=1).collect()}
    assert got == {
        1: "accepted", 2: "dup_id", 3: "dup_hash", 4: "accepted", 5: "dup_id", 6: "dup_hash",
    }


def test_against_the_store(spark):
    store = spark.createDataFrame(
        [("a", "x"), ("legacy", None)], "id_article string, content_hash string"
    )
    batch = spark.createDataFrame(
        [(1, "a", "n1"), (2, "b", "x"), (3, "c", "n3"), (4, "legacy", "n4"), (5, "d", "n3")],
        "entry_ord int, id_article string, content_hash string",
    )
    for hot_rows in (1, 1000):
        left = drop_stored(batch, store, hot_rows=hot_rows)
        assert sorted(r.entry_ord for r in left.collect()) == [3, 5]
    ids_only = drop_stored(batch, store.select("id_article"))
    assert sorted(r.entry_ord for r in ids_only.collect()) == [2, 3, 5]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_spread_join_equals_a_plain_join(spark, how):
    left = spark.range(200).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 20).cast("string"))
        ).alias("k"),
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, v int")
    want = sorted(map(repr, left.join(right, "k", how).collect()))
    for hot_rows in (5, 10_000):
        got = spread_join(left, right, ["k"], how, ["n"], hot_rows=hot_rows)
        assert sorted(map(repr, got.collect())) == want


def test_hot_keys_are_few_and_split_by_size(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [r._pieces for r in hot_keys(df, ["k"], 100).collect()] == [4]
    assert hot_keys(df.limit(0), ["k"], 100).count() == 0


def test_hot_keys_are_found_among_more_keys_than_the_sketch_keeps(spark):
    """300,000 keys; one holds a third of all rows, one a tenth, NULL a tenth."""
    key = (
        F.when(F.col("id") % 3 == 0, -1)
        .when(F.col("id") % 10 == 1, -2)
        .when(F.col("id") % 10 == 2, None)
        .otherwise(F.col("id"))
    )
    df = spark.range(0, 600_000, 1, 24).select(key.alias("k"))
    exact = {r._k: r.n for r in df.groupBy(F.xxhash64("k").alias("_k")).agg(F.count("*").alias("n")).filter("n > 20000").collect()}
    got = {r._k: r._pieces for r in hot_keys(df, ["k"], 20_000).collect()}
    assert len(exact) == 3 and set(got) == set(exact)
    assert all(abs(got[k] - exact[k] / 20_000) <= 1 for k in exact)


@pytest.mark.parametrize("bits", [1 << 10, 1 << 20])
def test_likely_members(spark, bits):
    wide = spark.range(3000).withColumn("html", F.lit("x"))
    keys = stage(spark.range(0, 3000, 7), "some")
    got = {r.id for r in likely_members(wide, keys, "id", most_bits=bits).collect()}
    # None is missed, and with enough bits few others pass.
    assert set(range(0, 3000, 7)) <= got
    assert bits == 1 << 10 or len(got) < 500
    none = likely_members(wide, stage(spark.range(0), "none"), "id")
    assert none.count() == 0
    shown = likely_members(wide, keys, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in shown.split("Subquery")[0]
