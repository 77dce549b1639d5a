"""Fill-in-the-middle against slices, and back."""

import hashlib
import re

from pyspark.sql import functions as F

from newsloom.llm.fill_in_middle import count_units, fill_in_middle, restored

TEXTS = [
    None, "", "a", "ab", "é\n\r\n\t ", "a$1\\b{3}[^x]*", "𝄞" * 7 + "é🤦🏼‍♂️", "x" * 4096, "y" * 4097, "line\n" * 3000,
    "z🎈" * 150_000, "a<P>b", "a<S>b", "<M>", "<", "<S", "S>", "<P", ">", "<<S", "tail <", "\x00 \u0085",
]


def drawn(doc_id, n):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return a, b, h[2] % 100, h[3] % 100


def expected(doc_id, text):
    text = text or ""
    a, b, cut, order = drawn(doc_id, len(text))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or cut >= 90:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if order < 20:
        return len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_equals_slices_and_comes_back(spark):
    rows = [(i * 100 + j, t) for i in range(12) for j, t in enumerate(TEXTS)] + [(None, "no id"), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id bigint, text string, form string, output int")
    made = fill_in_middle(docs).withColumn("back", restored(F.col("output"), F.col("form")))
    got = [tuple(r) for r in made.collect()]
    want = [(i, t or "", *expected(i, t), t or "") for i, t in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert {r[3] for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_units_of_words(spark):
    word = r"\S+\s*+"
    texts = ["one two  three\nfour", "x", " ".join(map(str, range(9000)))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in fill_in_middle(docs, unit=word, cut_percent=100).collect():
        words = re.findall(word, texts[r.doc_id])
        assert r.n_units == len(words)
        a, b, _, order = drawn(r.doc_id, len(words))
        assert (r.prefix_units, r.middle_units) == (a, b - a)
        p, m, s = "".join(words[:a]), "".join(words[a:b]), "".join(words[b:])
        assert r.output == (f"<S>{s}<P>{p}<M>{m}" if order < 20 else f"<P>{p}<S>{s}<M>{m}")
    counts = docs.select(count_units(F.col("text"))).collect()
    assert [r[0] for r in counts] == [len(t) for t in texts]
