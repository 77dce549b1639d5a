"""Line de-duplication and sharding: edge cases and brute force."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from newsloom.llm import line_dedup, sharding

DOCS = "doc_id bigint, text string, source string, n_lines string, size int, shard string"


def pages(spark, rows):
    return spark.createDataFrame([(i, t, s, "own", 1, "own") for i, t, s in rows], DOCS)


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def test_boilerplate_goes_and_copies_stay(spark):
    rows = [(i, f"Menu\nstory {i}\n\nMenu", "a") for i in range(6)]
    rows += [(10 + i, "Menu\nMenu", "a") for i in range(2)]
    rows += [(20, "Menu\nx", "b"), (21, None, "a"), (22, "", "a"), (23, "Menu\nx", None), (24, " \n\t", "a")]
    rows += [(25, "Menu\nlong " + "word " * 200_000, "a")]
    got = by_id(line_dedup.drop_frequent_lines(pages(spark, rows), "source"), "text", "n_lines", "n_dropped")
    assert got[0] == ("story 0\n", 3, 2)
    assert got[10] == ("Menu\nMenu", 2, 0)
    assert got[20] == ("Menu\nx", 2, 0)
    assert got[21] == (None, 0, 0)
    assert got[22] == ("", 0, 0)
    assert got[23] == ("Menu\nx", 2, 0)
    assert got[24] == (" \n\t", 0, 0)
    assert got[25][1:] == (2, 1) and got[25][0].startswith("long word")


def test_near_copies_keep_their_text(spark):
    article = [f"line {n} of the article" for n in range(10)]
    rows = [(0, "\n".join(article), "a")]
    for i in range(1, 30):
        copy = list(article)
        copy[i % 10] = f"edited {i}"
        rows.append((i, "\n".join(copy), "a"))
    rows += [(i, f"own {i}\nmore {i}\nAll rights reserved", "a") for i in range(30, 100)]
    rows.append((100, "\n".join([*article[:9], "edited", "All rights reserved"]), "a"))
    got = by_id(line_dedup.drop_frequent_lines(pages(spark, rows), "source"), "text")
    for i, text, _ in rows:
        assert got[i] == (text.removesuffix("\nAll rights reserved"),)


def test_ratio_is_of_the_host(spark):
    rows = [(i, f"shared\n{i}" if i < 5 else f"{i}", "big") for i in range(100)]
    rows += [(200 + i, f"shared\n{i}", "small") for i in range(5)]
    docs = pages(spark, rows)
    found = line_dedup.frequent_lines(docs, "source").collect()
    assert [(r.host, r.pages, r.host_pages) for r in found] == [("small", 5, 5)]
    assert line_dedup.frequent_lines(docs, "source", min_ratio=0.04).count() == 2


def test_lines_of_repeated_rows_and_of_nothing(spark):
    rows = [(1, "same\nown", "a")] * 5
    got = line_dedup.drop_frequent_lines(pages(spark, rows), "source")
    assert got.count() == 5 and got.columns[:3] == ["doc_id", "text", "source"]
    none = pages(spark, []).limit(0)
    assert line_dedup.drop_frequent_lines(none, "source").count() == 0
    assert sharding.shard_documents(none, 4).count() == 0


def test_shards(spark):
    rows = [(i, f"t{i % 37} " * (i % 37 * 40 + 1), "a") for i in range(300)]
    rows += [(900, None, "a"), (901, "", "a"), (None, "null id", "a"), (5, rows[5][1], "a"), (902, "x" * 2_000_000, "a")]
    got = sharding.shard_documents(pages(spark, rows), 6).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    slots, homes, load = defaultdict(list), defaultdict(set), Counter()
    texts = {i: t or "" for i, t, _ in rows}
    for r in got:
        text = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(text) + 16, zlib.crc32(text))
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 6
        slots[r.shard].append(r.slot)
        homes[text].add(r.shard)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    # All but the shard of the longest text are near equal.
    rest = sorted(load.values())[:-1]
    assert rest[-1] - rest[0] <= max(Counter({k: sum(len(k) + 16 for r in rows if (r[1] or "").encode() == k) for k in homes if len(k) < 10**6}).values())


def test_longest_first():
    items = [("a", 7), ("b", 5), ("c", 4), ("d", 3), ("e", 1)]
    assert sharding.longest_first(items, 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    assert sharding.longest_first([], 3) == {}


def test_longest_first_equals_a_search_of_all_shards():
    r = random.Random(1)
    for shards in (1, 3, 40):
        items = [(i, r.choice([1, 5, 5, 17, r.randrange(1000)])) for i in range(300)]
        loads, want = [0] * shards, {}
        for i, size in sorted(items, key=lambda x: (-x[1], x[0])):
            home = loads.index(min(loads))
            want[i] = home
            loads[home] += size
        assert sharding.longest_first(items, shards) == want


def test_groups_above_the_share_are_placed_as_in_plain_scheduling(spark):
    r = random.Random(2)
    sizes = {g: r.randrange(500, 2000) for g in range(60)}
    rows = spark.createDataFrame([(g, g, s) for g, s in sizes.items()], "doc_id bigint, g bigint, size bigint")
    got = sharding.assign_shards(rows, ["g"], "size", 4, ["doc_id"], parts_per_shard=64, rows_per_slice=100)
    loads = Counter()
    for x in got.collect():
        loads[x.shard] += sizes[x.g]
    plain = sharding.longest_first(sizes.items(), 4)
    want = Counter()
    for g, shard in plain.items():
        want[shard] += sizes[g]
    assert sorted(loads.values()) == sorted(want.values())


def test_large_groups_are_scheduled_one_by_one(spark):
    rows = spark.range(4000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 50).alias("g"), F.lit(10).cast("bigint").alias("size")
    )
    got = sharding.assign_shards(rows, ["g"], "size", 5, ["doc_id"], parts_per_shard=20, rows_per_slice=100)
    assert {r["count"] for r in got.groupBy("shard").count().collect()} == {800}
    assert got.groupBy("g").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count() == 0
