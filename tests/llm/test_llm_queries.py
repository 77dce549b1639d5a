"""The registered queries on the smallest tables; the pipeline by its stages."""

import pandas as pd
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from compare import connect, difference
from newsloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, name):
    assert difference(spark, connect(SF), name, SF) is None


def test_pipeline(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near-copies", "leaks", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs.toPandas()]
    for name, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, SF), name)
        frames.append(docs.toPandas())
    start, good, lines, distinct, clean, coded = frames
    columns = list(start.columns)
    assert all(list(f.columns) == columns for f in frames[:-1])
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id")
    rejected = set(start.doc_id) - set(good.doc_id)
    wrong = [i for i in rejected & set(labels.index) if labels.quality[i] == 1 and labels.toxic[i] == 0]
    assert len(wrong) <= 0.02 * len(labels)
    assert set(lines.doc_id) == set(good.doc_id)
    assert (lines.n_chars == lines.text.str.len()).all()
    assert set(distinct.doc_id) <= set(lines.doc_id) and distinct.text.is_unique
    items = pd.read_parquet(f"{SF}/benchmark.parquet").text
    leaking = {i for i, t in zip(distinct.doc_id, distinct.text) if any(x in t for x in items)}
    assert leaking and not leaking & set(clean.doc_id)
    assert set(coded.doc_id) == set(clean.doc_id) and coded.round_trip.all()
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(coded)


def test_pipeline_of_odd_documents(spark):
    """NULL, empty, long and repeated texts, and columns named as the stages' own."""
    named = ["kept", "n_dropped", "n_lines", "leaks", "n_tokens", "ids", "round_trip", "found", "__host", "component_id"]
    words = " ".join(f"word{i}" for i in range(400))
    rows = [(1, None, 0), (2, "", 0), (3, words, len(words)), (3, words, len(words)), (4, words + " tail", 0), (None, "no id", 5),
            (5, "x " * 300_000, 0)]
    docs = spark.createDataFrame(
        [(i, t, "en", None, n, *[f"own {k}" for k in named]) for i, t, n in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{k}` string" for k in named),
    )
    for frame in (docs, docs.limit(0)):
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, frame, SF)
            got = out.toPandas()
            if name == "tokens":
                assert {"n_tokens", "ids", "round_trip", "documents_ids"} <= set(out.columns)
                assert got.round_trip.all() if len(got) else True
            else:
                assert out.columns == docs.columns
                assert all((got[k] == f"own {k}").all() for k in named)
            if name in ("lines", "tokens"):
                assert len(got) == frame.count()
