"""Line de-duplication by the frequency of a line within its site."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.sources.staging import stage

MIN_RATIO = 0.05
#: A page with a smaller share of lines of its own is a copy of others, and no evidence.
MIN_OWN_SHARE = 0.25
MIN_PAGES = 4
#: A line counts if it has a character other than white space.
HAS_WORD = r"[^\x20\x09-\x0D]"


def frequent_lines(
    docs: DataFrame,
    host: str,
    text: str = "text",
    min_ratio: float = MIN_RATIO,
    min_pages: int = MIN_PAGES,
    min_own_share: float = MIN_OWN_SHARE,
) -> DataFrame:
    """Lines that stand on more than ``min_ratio`` of a host's pages, and on ``min_pages`` at least.

    One row for each (host, line hash): ``host, line_key, pages, host_pages``. A page
    counts once for a line, however often it repeats it. Near copies of one article make all
    its lines frequent without making them boilerplate. So lines are counted twice: on all
    pages first, then only on those with at least ``min_own_share`` of lines that the first
    count does not list. Pages without a host belong to no site. A host has at most (lines of
    its mean page / min_ratio) such lines.
    """
    known = docs.filter(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.col(text).alias("text"))
    totals = known.groupBy("host").agg(F.count("*").alias("host_pages"))

    def over_ratio(lines: DataFrame) -> DataFrame:
        counts = lines.groupBy("host", "line_key").agg(F.count("*").alias("pages")).filter(F.col("pages") >= min_pages)
        return counts.join(totals, "host").filter(
            F.col("pages") > F.lit(float(min_ratio)) * F.col("host_pages")
        )

    distinct = F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")
    worded = known.select("host", distinct).filter(F.col("line").rlike(HAS_WORD))
    first = _by_host(over_ratio(worded.select("host", F.xxhash64("line").alias("line_key"))))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD))
    placed = known.join(first, "host").select("host", "keys", lines.alias("lines"))
    shared = F.filter(F.transform("lines", lambda x: F.xxhash64(x)), lambda k: F.array_contains("keys", k))
    seen = placed.select("host", F.size("lines").alias("n"), shared.alias("shared")).filter(
        F.col("n") - F.size("shared") >= F.lit(float(min_own_share)) * F.col("n")
    )
    return over_ratio(seen.select("host", F.explode(F.array_distinct("shared")).alias("line_key")))


def _by_host(frequent: DataFrame) -> DataFrame:
    """``host, keys``; written, so that its size is known and Spark broadcasts it only if it is small."""
    return stage(frequent.groupBy("host").agg(F.collect_list("line_key").alias("keys")), "frequent-lines")


def _is_frequent(line: Column, keys: Column) -> Column:
    return F.array_contains(keys, F.xxhash64(line))


def drop_frequent_lines(
    docs: DataFrame,
    host: str,
    text: str = "text",
    min_ratio: float = MIN_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with boilerplate lines cut out of ``text``, and ``n_lines``, ``n_dropped``.

    A line (text between line feeds, compared exactly) goes if `frequent_lines` has it
    for the page's host; every occurrence on the page goes. Lines without a word are
    neither counted nor dropped. Near copies are no evidence, so the lines of an article
    don't go for being on many copies. A page on which no other line has a word is a copy and
    not a frame, and stays whole. NULL text: 0 lines, stays NULL; NULL host: unchanged;
    empty text: no line. Repeated rows are pages of their own. Other columns pass
    through; columns named n_lines and n_dropped are replaced.
    """
    frequent = frequent_lines(docs, host, text, min_ratio, min_pages)
    keys = _by_host(frequent).select(F.col("host").alias("__host"), F.col("keys").alias("__keys"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(HAS_WORD))
    rest = F.filter(F.split(text, "\n"), lambda x: ~_is_frequent(x, F.col("__keys")))
    cut = docs.join(keys, F.col(host) == F.col("__host"), "left").withColumn(
        "n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("bigint")
    )
    touched = F.col("__keys").isNotNull() & F.col(text).isNotNull()
    cut = cut.withColumn("__rest", F.when(touched, rest))
    cut = cut.withColumn(
        "__left", F.size(F.filter(F.col("__rest"), lambda x: x.rlike(HAS_WORD))).cast("bigint")
    )
    drops = touched & (F.col("__left") > 0) & (F.col("__left") < F.col("n_lines"))
    return (
        cut.withColumn(
            "n_dropped", F.when(drops, F.col("n_lines") - F.col("__left")).otherwise(F.lit(0))
        )
        .withColumn(text, F.when(drops, F.array_join("__rest", "\n")).otherwise(F.col(text)))
        .select(*dict.fromkeys([*docs.columns, "n_lines", "n_dropped"]))
    )


#: For `drop_frequent_lines` over documents, with the source as host.
ORACLE_SQL = f"""
WITH pages AS (
  SELECT row_number() OVER () AS r, doc_id, source, text FROM documents
), lines AS (
  SELECT r, source, u.i AS i, list_extract(string_split(text, chr(10)), u.i) AS line
  FROM pages, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
), worded AS (
  SELECT * FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), totals AS (
  SELECT source, count(*) AS n FROM pages GROUP BY source
), first AS (
  SELECT w.source, w.line FROM worded w JOIN totals t ON w.source = t.source
  GROUP BY w.source, w.line, t.n
  HAVING count(DISTINCT r) >= {MIN_PAGES} AND count(DISTINCT r) > {MIN_RATIO}::DOUBLE * t.n
), evidence AS (
  SELECT w.r FROM worded w LEFT JOIN first f ON w.source = f.source AND w.line = f.line
  GROUP BY w.r HAVING count(*) FILTER (f.line IS NULL) >= {MIN_OWN_SHARE}::DOUBLE * count(*)
), frequent AS (
  SELECT w.source, w.line FROM worded w JOIN totals t ON w.source = t.source
  JOIN first f ON w.source = f.source AND w.line = f.line JOIN evidence e ON w.r = e.r
  GROUP BY w.source, w.line, t.n
  HAVING count(DISTINCT w.r) >= {MIN_PAGES} AND count(DISTINCT w.r) > {MIN_RATIO}::DOUBLE * t.n
), marked AS (
  SELECT l.r, l.i, l.line, f.line IS NOT NULL AS goes,
         regexp_matches(l.line, '[^\\x20\\x09-\\x0D]') AS has_word
  FROM lines l LEFT JOIN frequent f ON l.source = f.source AND l.line = f.line
), per_page AS (
  SELECT r, count(*) FILTER (has_word) AS n_lines, count(*) FILTER (goes) AS n_goes,
         string_agg(line, chr(10) ORDER BY i) FILTER (NOT goes) AS rest
  FROM marked GROUP BY r
)
SELECT p.doc_id, coalesce(q.n_lines, 0) AS n_lines,
       CASE WHEN q.n_goes < q.n_lines THEN q.n_goes ELSE 0 END AS n_dropped,
       CASE WHEN q.n_goes > 0 AND q.n_goes < q.n_lines THEN q.rest ELSE p.text END AS text
FROM pages p LEFT JOIN per_page q ON p.r = q.r
"""
