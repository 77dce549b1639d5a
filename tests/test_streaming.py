"""Streams: late AMP twins, batches that end half-way, outcomes."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsloom import extract_articles, ingest, ingest_stream, open_store, run_report
from newsloom.plans.articles import page_articles
from newsloom.plans.ingest import page_outcomes
from newsloom.sources import store as store_source
from newsloom.sources.staging import staging_root
from newsloom.streaming import incremental, state
from newsloom.streaming.incremental import settle_waiting, stream_outcomes

OPTIONS = {"content_policy": "selectors"}
LONG = "all of the text " * 40


def short(n, amp=None, words="first words "):
    link = f'<link rel="amphtml" href="{amp}">' if amp else ""
    return f"<head>{link}</head><article><h1>T{n}</h1><p>{words * 20}</p></article>"


def twin(n):
    return f"<article><h1>A{n}</h1><p>{LONG}{n}</p></article>"


def long(n, text=LONG):
    return f"<article><h1>T{n}</h1><p>{text * 2}</p></article>"


def land(spark, folder, *rows):
    df = spark.createDataFrame(list(rows), "page_id bigint, url string, html string")
    df.coalesce(1).write.mode("append").parquet(folder)


def run(spark, landing, store, checkpoint, **more):
    ingest_stream(spark, landing, store, str(checkpoint), **OPTIONS, **more).awaitTermination()


def rows(spark, store):
    return sorted((r.entry_ord, r.title, r.content) for r in open_store(spark, store).collect())


# Pages 1, 2 and 4 have twins 11, 12 and (never landed) 14; page 3 has the id of page 1.
PAGES = {
    1: (1, "http://w.com/a", short(1, "http://amp.com/a")),
    2: (2, "http://w.com/b", short(2, "http://amp.com/b")),
    3: (3, "http://w.com/a/", long(3)),
    4: (4, "http://w.com/d", short(4, "http://amp.com/d")),
    5: (5, "http://w.com/e", long(5)),
    11: (11, "http://amp.com/a", twin(1)),
    12: (12, "http://amp.com/b", twin(2)),
}


@pytest.mark.parametrize("first", [(1, 2, 3, 4, 5), (11, 12), (2, 3, 5, 11)])
def test_twins_may_land_in_any_batch(spark, tmp_path, first):
    landing, store, whole = (str(tmp_path / n) for n in ("land ing", "store", "whole"))
    for part in (first, [n for n in PAGES if n not in first]):
        if part:
            land(spark, landing, *[PAGES[n] for n in part])
            run(spark, landing, store, tmp_path / "c1")
    held = {r.ord for r in stream_outcomes(spark, store).filter("outcome = 'waiting'").collect()}
    assert held == {4}
    settle_waiting(spark, store, **OPTIONS)
    every = spark.createDataFrame(list(PAGES.values()), "page_id bigint, url string, html string")
    ingest(extract_articles(every, **OPTIONS), whole)
    if first == (2, 3, 5, 11):
        # Page 3 was complete before page 1 landed, so it has the address.
        assert {n for n, _, _ in rows(spark, store)} == {2, 3, 4, 5, 11, 12}
    else:
        assert rows(spark, store) == rows(spark, whole)
        assert {n for n, _, _ in rows(spark, store)} == {1, 2, 4, 5, 11, 12}
    texts = {n: c for n, _, c in rows(spark, store)}
    assert texts[2] == f"{LONG}2" and texts[4].startswith("first words")
    # A lost checkpoint replays everything.
    before = rows(spark, store)
    run(spark, landing, store, tmp_path / "c2", max_files_per_trigger=1)
    settle_waiting(spark, store, **OPTIONS)
    assert rows(spark, store) == before


@pytest.mark.parametrize("where", ["within the append", "before the end"])
def test_a_batch_that_ended_half_way_counts_once(spark, tmp_path, monkeypatch, where):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    land(spark, landing, PAGES[1], PAGES[5], (6, "http://w.com/e/", long(6)))
    append, note = incremental.append_articles, state.note

    def broken_append(articles, path):
        if where == "within the append":
            append(articles.filter("entry_ord = 5"), path)
        raise RuntimeError("lost")

    def broken_note(spark, store, seq, run, batch, step):
        if step == state.DONE:
            raise RuntimeError("lost")
        note(spark, store, seq, run, batch, step)

    with monkeypatch.context() as m:
        if where == "before the end":
            m.setattr(state, "note", broken_note)
        else:
            m.setattr(incremental, "append_articles", broken_append)
        with pytest.raises(Exception, match="lost"):
            run(spark, landing, store, tmp_path / "c")
    run(spark, landing, store, tmp_path / "c")
    assert [n for n, _, _ in rows(spark, store)] == [5]
    outcomes = {r.ord: r.outcome for r in stream_outcomes(spark, store).collect()}
    assert outcomes == {1: "waiting", 5: "accepted", 6: "dup_id"}
    land(spark, landing, PAGES[11])
    run(spark, landing, store, tmp_path / "c")
    assert [n for n, _, _ in rows(spark, store)] == [1, 5, 11]
    assert stream_outcomes(spark, store).filter("outcome = 'accepted'").count() == 3


def test_a_batch_that_is_through_is_not_taken_again(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    land(spark, landing, PAGES[5])
    run(spark, landing, store, tmp_path / "c")
    stream = incremental._run_of(spark, str(tmp_path / "c"))
    at = state.place(spark, store, stream, 0)
    assert at.done and at.seq == 1
    again = spark.read.parquet(landing).withColumn("file", F.lit("none"))
    incremental._Batches(store, **OPTIONS).run(again, stream, 0)
    assert state.place(spark, store, stream, 1) == state.Place(2, False, False, 1)
    assert state.place(spark, store, "other", 0) == state.Place(2, False, False, 1)


def test_outcomes_of_a_stream_are_those_of_one_batch(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    pages = [
        (1, "http://w.com/a", long(1)), (2, "http://w.com/a/", long(2)), (3, "http://[bad", long(3)),
        (4, "http://w.com/t", "<article><h1>x</h1><p>thin</p></article>"),
        (5, "http://w.com/f", long(1)), (6, "http://w.com/g", long(6, "g " * 200)),
    ]
    for part in (pages[:2], pages[2:4], pages[4:]):
        land(spark, landing, *part)
        run(spark, landing, store, tmp_path / "c")
    one = page_outcomes(page_articles(spark.createDataFrame(pages, "page_id bigint, url string, html string"), **OPTIONS))
    assert sorted(map(repr, stream_outcomes(spark, store).collect())) == sorted(map(repr, one.collect()))
    assert sorted(map(repr, run_report(stream_outcomes(spark, store)).collect())) == sorted(map(repr, run_report(one).collect()))


def test_a_batch_leaves_no_staged_tables_and_shuffles_no_texts(spark, tmp_path, monkeypatch):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    root = Path(staging_root(spark))
    land(spark, landing, *PAGES.values())
    before, chosen = set(root.iterdir()), []

    def seen(articles, path):
        chosen.append(articles._jdf.queryExecution().executedPlan().toString())
        append(articles, path)

    append = incremental.append_articles
    monkeypatch.setattr(incremental, "append_articles", seen)
    run(spark, landing, store, tmp_path / "c")
    settle_waiting(spark, store, **OPTIONS)
    assert set(root.iterdir()) == before
    assert len(chosen) == 2 and not any("Exchange hashpartitioning" in plan for plan in chosen)
    assert {n for n, _, _ in rows(spark, store)} == {1, 2, 4, 5, 11, 12}


def test_custom_extraction_and_an_empty_store(spark, tmp_path):
    landing, store = str(tmp_path / "landing"), str(tmp_path / "store")
    assert stream_outcomes(spark, store).collect() == []
    land(spark, landing, PAGES[5], (6, "http://w.com/g", long(6, "other " * 40)))
    ingest_stream(
        spark, landing, store, str(tmp_path / "c"), extract=lambda pages: extract_articles(pages, **OPTIONS).filter("entry_ord > 5")
    ).awaitTermination()
    assert [n for n, _, _ in rows(spark, store)] == [6]
    assert store_source.open_store(spark, store).count() == 1
