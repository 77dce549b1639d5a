"""Incremental runs over landed pages.

Each micro-batch goes through the same steps as a full run, with the store and what
``newsloom.streaming.state`` keeps beside it as the only state: the horizon is unbounded, and the
two-key rule is not expressible as a streaming ``dropDuplicates``.

A page whose text is short and whose AMP twin has not landed waits; a later batch that
brings the twin decides it. Pages that share the id of a waiting one and come after it
wait with it, since it would win over them. ``settle_waiting`` ends the waiting. So it
does not matter in which batches a page and its twin land. A page with a text of its own that
is stored meanwhile is not taken back: if the waiting one turns out to have the same text, it is
the duplicate.

Every batch counts once. A batch that ended between its append and the checkpoint is
replayed by Spark; its decisions are found written, and only rows that the store does
not have yet are appended.
"""

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsloom.operators.joins import spread_join
from newsloom.plans.articles import as_store_rows, own_articles, read_twins
from newsloom.plans.ingest import accept, drop_known, entry_order, key_outcomes, known_keys
from newsloom.schemas import MIN_BODY_CHARS, STORE_SCHEMA, THIN_CHARS
from newsloom.sources.keys import key_rows, stored_among
from newsloom.sources.pages import loaded_pages
from newsloom.sources.places import PLACE, bitmaps, located, picked
from newsloom.sources.staging import released, row_count, same_rows, stage_counted
from newsloom.sources.store import append_articles, open_store
from newsloom.streaming import state

PAGES_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        # Read as NULL where a landing has no such column.
        T.StructField("status", T.IntegerType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)

# A waiting page: a store row with what is needed to judge it again.
_WAITING = T.StructType(
    [
        *STORE_SCHEMA.fields,
        T.StructField("page_id", T.LongType()),
        T.StructField("norm_url", T.StringType()),
        T.StructField("amp_href", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
    ]
)


# The name of a row for the decisions.
_NAME = ["profile", "ord", "id", "hash"]


class _Split(NamedTuple):
    """A batch: located tables with the texts, narrow rows to decide with their places, rows that wait."""

    tables: list[DataFrame]
    ready: DataFrame
    waiting: DataFrame


class _Batches:
    """The steps of a batch, for one store and one set of options."""

    def __init__(
        self,
        store: str,
        pages_schema: T.StructType = PAGES_SCHEMA,
        extract: Callable[[DataFrame], DataFrame] | None = None,
        selector_policy: str = "four",
        content_policy: str = "full",
        min_chars: int = MIN_BODY_CHARS,
        thin_chars: int = THIN_CHARS,
        profile: str = "default",
        **row_options,
    ):
        self.store, self.pages_schema, self.extract = store, pages_schema, extract
        self.page_options = {"selector_policy": selector_policy, "content_policy": content_policy}
        self.limits = {"min_chars": min_chars, "thin_chars": thin_chars}
        self.row_options = {"profile": profile, **row_options}

    def run(self, pages: DataFrame | None, run: str, batch: int) -> None:
        """Take a batch of landed pages with ``file``; without pages, decide all that wait."""
        spark = pages.sparkSession if pages is not None else SparkSession.active()
        with released(spark):
            self._take(spark, pages, run, batch)

    def _take(self, spark: SparkSession, pages: DataFrame | None, run: str, batch: int) -> None:
        store = self.store
        open_store(spark, store)
        at = state.place(spark, store, run, batch)
        if at.done:
            return
        held = located(state.waiting(spark, store, _WAITING))
        landed = None
        if pages is None:
            split = _Split([held], self._named(held), held.limit(0))
        elif self.extract is not None:
            own = located(stage_counted(self.extract(pages.drop("file")), "batch"))
            own = own.withColumn("reject_reason", F.lit(None).cast("string"))
            split = _Split([own], self._named(own), held.limit(0))
        else:
            loaded = loaded_pages(pages)
            landed = state.landed_rows(loaded)
            split = self._split(loaded, landed, held)
        if not at.decided:
            state.write_part(self._decide(split.ready), store, "decided", at.seq)
            state.write_part(split.waiting.select(*_WAITING.names), store, "waiting", at.seq)
            state.note(spark, store, at.seq, run, batch, state.DECIDED)
        outcomes = state.read_part(spark, store, "decided", at.seq, state.DECIDED_SCHEMA)
        names = outcomes.filter("outcome = 'accepted'").select(*_NAME)
        if at.decided:
            # The batch was here before; part or all of it may be in the store.
            again = names.select("profile", F.col("ord").alias("entry_ord"), F.col("id").alias("id_article"), "hash")
            new = drop_known(stage_counted(again, "again"), store, ("id_article",))
            names = new.select("profile", F.col("entry_ord").alias("ord"), F.col("id_article").alias("id"), "hash")
        # Of several rows with one name, one.
        won = split.ready.join(names, _NAME).groupBy(*_NAME).agg(F.min(F.struct(*PLACE)).alias("at"))
        append_articles(picked(split.tables, bitmaps(won.select("at.*"))), store)
        if landed is not None:
            state.land(landed, store)
        state.note(spark, store, at.seq, run, batch, state.DONE)

    def _split(self, loaded: DataFrame, landed: DataFrame, held: DataFrame) -> "_Split":
        """Rows to decide now, and rows that wait for a twin.

        All is settled on narrow columns; texts stay where they are and are picked by their places.
        """
        spark, store = loaded.sparkSession, self.store
        few = (F.length("content") < self.limits["min_chars"]) & F.col("amp_href").isNotNull()
        open_to_text = F.col("reject_reason").isNull() | (F.col("reject_reason") == "thin")
        few, asks = (F.coalesce(x, F.lit(False)) for x in (few, open_to_text & few))
        marks = [few.alias("few"), asks.alias("asks")]
        own = located(own_articles(loaded.drop("file"), **self.page_options, **self.limits, more=marks))
        rows = self._store_shaped(own)
        named = self._named(self._store_shaped(own, "few", "asks"), "few", "asks").unionByName(
            self._named(held, marks[0], F.col("amp_href").isNotNull().alias("asks"))
        )
        named = stage_counted(named, "named")
        asking = stage_counted(named.filter("asks"), "asking")
        if not row_count(asking):
            return _Split([rows, held], named, held.limit(0))
        found = state.newest_landings(spark, store, landed, asking)
        asked = self._asked(asking, found)
        answered = asked.filter("found AND few")
        tables, judged = [rows, held], named.filter("NOT asks")
        files = state.files_of(found)
        if files:
            lookup = spark.read.schema(self.pages_schema).parquet(*files)
            newest = same_rows(found.select("amp_href", F.col("page_id").alias("twin_id")), found)
            twins = read_twins(self._needing(tables, answered), newest, lookup, self.limits["thin_chars"])
            twins = located(twins).select(*_WAITING.names, *PLACE)
            tables, judged = [*tables, twins], judged.unionByName(self._named(twins), allowMissingColumns=True)
        # What the store has already need not wait to be refused.
        patient = asked.filter("NOT found AND NOT stored")
        settled = asked.filter("found AND NOT few OR NOT found AND stored")
        judged = judged.unionByName(settled, allowMissingColumns=True)
        # A page that comes after a waiting one with its id waits with it.
        first = patient.groupBy("profile", "id").agg(F.min("page_id").alias("_first"))
        behind = F.coalesce(F.col("page_id") > F.col("_first"), F.lit(False)) & F.col("reject_reason").isNull()
        marked = judged.join(first, ["profile", "id"], "left").withColumn("behind", behind)
        marked = stage_counted(marked.select(*asking.columns, "behind"), "marked")
        blocked = picked(tables, bitmaps(marked.filter("behind").select(*PLACE)))
        waiting = picked(tables[:2], bitmaps(patient.select(*PLACE))).unionByName(
            blocked.withColumn("amp_href", F.lit(None).cast("string"))
        )
        return _Split(tables, marked.filter("NOT behind"), waiting)

    def _asked(self, asking: DataFrame, found: DataFrame) -> DataFrame:
        """Staged narrow rows with ``found``, whether their twin landed, and ``stored``, whether the store has their id."""
        keys = same_rows(key_rows(asking.select("profile", "id"), "id"), asking)
        ids = stored_among(asking.sparkSession, self.store, keys).select("profile", F.col("key").alias("id"), F.lit(True).alias("stored"))
        landed = found.select("amp_href", F.lit(True).alias("found"))
        asked = spread_join(asking, landed, ["amp_href"], "left", ["ord"])
        asked = spread_join(asked, ids, ["profile", "id"], "left", ["ord"], asking)
        return stage_counted(asked.fillna(False, ["found", "stored"]), "asked")

    @staticmethod
    def _needing(tables: list[DataFrame], answered: DataFrame) -> DataFrame:
        """Texts to be replaced by those of their twins. Of a row whose id is stored, no text will be needed."""
        kinds = ((True, answered.filter("NOT stored")), (False, answered.filter("stored")))
        new, known = (picked(tables, bitmaps(x.select(*PLACE))).withColumn("keep", F.lit(keep)) for keep, x in kinds)
        needing = new.unionByName(known).drop(*PLACE)
        needing.staged_rows = answered.count()
        return needing

    def _store_shaped(self, own: DataFrame, *more: str) -> DataFrame:
        carry = ("page_id", "norm_url", "amp_href", "reject_reason", *PLACE, *more)
        return as_store_rows(own, **self.row_options, carry=carry).select(*_WAITING.names, *PLACE, *more)

    @staticmethod
    def _named(rows: DataFrame, *more: Column | str) -> DataFrame:
        """Narrow columns of located rows."""
        order = entry_order(F.col("feed_ord"), F.col("entry_ord")).alias("ord")
        names = [order, F.col("id_article").alias("id"), F.col("content_hash").alias("hash")]
        carried = [c for c in ("page_id", "amp_href") if c in rows.columns]
        return rows.select(*PLACE, "profile", "category", *names, "reject_reason", *carried, *more)

    def _decide(self, ready: DataFrame) -> DataFrame:
        """Outcome of every narrow row, the store being as it is now."""
        named = ready.select("category", *_NAME, "reject_reason")
        good = stage_counted(named.filter(F.col("reject_reason").isNull()).drop("reject_reason"), "good")
        hits = known_keys(good, self.store)
        decided = key_outcomes(good, accept(good, hits), hits).distinct()
        refused = named.filter(F.col("reject_reason").isNotNull()).withColumnRenamed("reject_reason", "outcome")
        return decided.unionByName(refused).select(*state.DECIDED_SCHEMA.names)


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, which its checkpoint keeps."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_stream(
    spark: SparkSession,
    pages_dir: str,
    store: str,
    checkpoint: str,
    schema: T.StructType = PAGES_SCHEMA,
    max_files_per_trigger: int | None = None,
    file_glob: str | None = None,
    extract: Callable[[DataFrame], DataFrame] | None = None,
    **extract_options,
) -> StreamingQuery:
    """Start a run over everything that landed since the last one.

    ``extract`` turns a batch of pages into article rows; by default it is what
    ``extract_articles`` does with ``extract_options``, AMP twins being looked up among the
    pages of this and earlier batches.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    batches = _Batches(store, schema, extract, **extract_options)

    def take(batch: DataFrame, batch_id: int) -> None:
        batches.run(batch, _run_of(batch.sparkSession, checkpoint), batch_id)

    return (
        reader.parquet(pages_dir)
        .select("*", F.col("_metadata.file_path").alias("file"))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def settle_waiting(spark: SparkSession, store: str, **extract_options) -> None:
    """Decide all waiting pages with the texts they have; a batch of its own.

    ``extract_options`` as for the stream.
    """
    open_store(spark, store)
    last = state.log(spark, store).agg(F.max("seq")).first()[0] or 0
    _Batches(store, **extract_options).run(None, "settle", last + 1)


def stream_outcomes(spark: SparkSession, store: str) -> DataFrame:
    """Outcome of every page that a batch decided, and ``waiting`` for those that wait."""
    columns = ["profile", "category", "ord", "outcome"]
    held = state.waiting(spark, store, _WAITING).withColumn("outcome", F.lit("waiting"))
    held = held.withColumn("ord", entry_order(F.col("feed_ord"), F.col("entry_ord")))
    return state.decided(spark, store).select(*columns).unionByName(held.select(*columns))
