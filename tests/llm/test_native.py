"""URL filters and quality rules: edge cases, brute force, and no Python in the plans."""

import datetime as dt
import math
import re
from collections import Counter

from newsloom.llm import quality_rules as rules
from newsloom.llm import url_filters as urls

D = dt.date


def test_as_of(spark):
    entries = spark.createDataFrame(
        [
            ("block", "bad.com", "add", D(2024, 1, 10)),
            ("block", "bad.com", "remove", D(2024, 2, 1)),
            ("block", "bad.com", "add", D(2024, 3, 1)),
            ("block", "bad.com", "add", D(2024, 3, 5)),
            ("allow", "ok.bad.com", "add", D(2024, 1, 1)),
            ("block", "site.org/x", "add", D(2024, 1, 1)),
            ("block", "tie.org", "add", D(2024, 1, 1)),
            ("allow", "tie.org", "add", D(2024, 1, 1)),
            ("block", "same.org", "remove", D(2024, 1, 1)),
            ("block", "same.org", "add", D(2024, 1, 1)),
            (None, "n.org", "add", D(2024, 1, 1)),
            ("block", None, "add", D(2024, 1, 1)),
            ("block", "n.org", "add", None),
        ],
        "list string, pattern string, action string, effective_on date",
    )
    cases = [
        ("http://bad.com/", D(2024, 1, 9), "none"),
        ("http://www.BAD.com:80/a?b#c", D(2024, 1, 10), "block"),
        ("http://bad.com", D(2024, 2, 1), "none"),
        ("http://bad.com", D(2024, 3, 1), "block"),
        ("http://bad.com", D(2025, 1, 1), "block"),
        ("https://a.ok.bad.com/", D(2024, 1, 15), "allow"),
        ("http://site.org/x/y", D(2024, 1, 1), "block"),
        ("http://site.org/xy", D(2024, 1, 1), "none"),
        ("http://tie.org", D(2024, 1, 1), "allow"),
        ("http://same.org", D(2024, 1, 1), "block"),
        ("http://n.org", D(2024, 1, 1), "none"),
        (None, D(2024, 1, 1), "none"),
        ("", D(2024, 1, 1), "none"),
        ("no address", D(2024, 1, 1), "none"),
        ("http://bad.com", None, "none"),
        ("http://bad.com/" + "a" * 100_000, D(2024, 1, 15), "block"),
        ("http://bad.com", D(2024, 3, 1), "block"),
    ]
    captures = spark.createDataFrame(
        [(i, u, d, "own", "own") for i, (u, d, _) in enumerate(cases)],
        "page_id bigint, url string, fetched_on date, verdict string, pattern string",
    )
    got = urls.judge_captures(captures, entries)
    assert {r.page_id: r.verdict for r in got.collect()} == {i: v for i, (_, _, v) in enumerate(cases)}
    assert got.columns == ["page_id", "url", "fetched_on", "pattern", "verdict", "rule"]
    assert urls.judge_captures(captures.limit(0), entries).count() == 0
    assert {r.verdict for r in urls.judge_captures(captures, entries.limit(0)).collect()} == {"none"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    found = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines),
        len(lines) - len(set(lines)),
        len(found),
    )


def test_counts(spark):
    texts = [
        None, "", " \n ", "one", "a b", "a b c", "a b c a b c", "a a a a", "x y z w x y z q x y z",
        "l\nl\n\nl\nm", "é è #*$%&|<> \x0b\x0c tab\there", "w " * 3000, " ".join(map(str, range(70_000))),
        "p q r " + " ".join(map(str, range(100))) + " p q r", "\U0001f600 \U0001f600 \U0001f600 \U0001f600",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs = docs.selectExpr("*", "'en' AS lang", "1 AS n_words", "2 AS __words")
    got = {r[0]: tuple(r[2:]) for r in rules.text_counts(docs).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_allowed_rejections_are_exact(spark):
    strata = spark.createDataFrame([("a", 40), ("b", 400), ("c", 5000), (None, 1)], "stratum string, n bigint")
    got = {r.n: r.allowed for r in rules.allowed_rejections(strata, 0.02, 10, 0.05).collect()}
    for n, k in got.items():
        def below(k):
            return sum(math.comb(n, i) * 0.02**i * 0.98 ** (n - i) for i in range(k + 1)) if k >= 0 else 0.0

        assert below(k) <= 0.05 / 40 < below(k + 1), n
    assert got[40] == got[1] == -1 and got[400] >= 0


def test_rules_keep_what_the_labels_ask_for(spark):
    good = " ".join(f"word{i}" for i in range(80))
    bad = " ".join(f"wo{i}%%%###" for i in range(80))
    rows = [(i, good + f" {i}", "en") for i in range(4000)] + [(5000 + i, bad + f" {i}", "en") for i in range(50)]
    rows += [(6000, bad, "xx"), (6001, None, "en"), (6002, "", None), (6003, bad, None), (6003, bad, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(4000)] + [(5000, 0, 0), (5001, None, 0), (None, 1, 0), (7, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    got = rules.judge(docs, labels)
    kept = {r.doc_id: r.kept for r in got.collect()}
    assert all(kept[i] for i in range(4000)) and not any(kept[5000 + i] for i in range(50))
    assert kept[6000] and kept[6003] and not kept[6001] and not kept[6002]
    assert got.count() == len(rows)
    # Without labels nothing but the base rules rejects.
    assert {r.kept for r in rules.judge(docs.limit(5), labels.limit(0)).collect()} == {True}
    assert rules.judge(docs.limit(0), labels).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
