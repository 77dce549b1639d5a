"""URL filters by dated lists: entries become intervals, captures meet those of their day.

DataFrame expressions only.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.sources.staging import stage

_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_REST = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*(.*)$"


def with_patterns(captures: DataFrame, url: str = "url") -> DataFrame:
    """``captures`` with ``__patterns``: all list patterns that cover the address.

    These are the host, its parent domains of two labels or more, the host with each
    leading part of the path, and the whole address without scheme, port and fragment.
    The host is lower-cased. No pattern for NULL or an address without scheme or host.
    """
    rest = F.regexp_replace(F.regexp_extract(url, _REST, 1), r"#.*$", "")
    split = (
        captures.withColumn("__host", F.lower(F.regexp_extract(url, _HOST, 1)))
        .withColumn("__rest", rest)
        .withColumn("__labels", F.split("__host", r"\."))
        .withColumn("__parts", F.array_remove(F.split(F.regexp_replace("__rest", r"\?.*$", ""), "/"), ""))
    )
    domains = F.expr(
        """CASE WHEN size(__labels) >= 2 THEN
        transform(sequence(1, size(__labels) - 1), i -> array_join(slice(__labels, i, size(__labels)), '.'))
        ELSE array(__host) END"""
    )
    paths = F.expr(
        """CASE WHEN size(__parts) >= 1 THEN
        transform(sequence(1, size(__parts)), i -> concat(__host, '/', array_join(slice(__parts, 1, i), '/')))
        ELSE array() END"""
    )
    whole = F.array(F.concat("__host", "__rest"))
    patterns = F.when(F.col("__host") != "", F.array_distinct(F.concat(domains, paths, whole)))
    return split.withColumn("__patterns", patterns).select(*captures.columns, "__patterns")


def intervals(entries: DataFrame) -> DataFrame:
    """Dated entries (``list, pattern, action, effective_on``) to ``list, pattern, valid_from, valid_to``.

    An entry holds from its day until the next day with an entry for the same list and
    pattern (``valid_to``, exclusive; NULL: still holds). 'add' puts the pattern on the
    list and 'remove' takes it off; of several on one day 'add' counts. Entries with a
    NULL are ignored. A pattern has at most one interval for each day.
    """
    days = (
        entries.filter(
            "list IS NOT NULL AND pattern IS NOT NULL AND action IS NOT NULL AND effective_on IS NOT NULL"
        )
        .groupBy("list", "pattern", "effective_on")
        .agg(F.max(F.col("action") == "add").alias("added"))
    )
    later = Window.partitionBy("list", "pattern").orderBy("effective_on")
    return (
        days.withColumn("valid_to", F.lead("effective_on").over(later))
        .filter("added")
        .select("list", "pattern", F.col("effective_on").alias("valid_from"), "valid_to")
    )


def judge_captures(
    captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "fetched_on"
) -> DataFrame:
    """``captures`` with ``verdict`` ('block', 'allow' or 'none') and the ``rule`` behind it.

    Every capture is held against the entries active on its day. The longest pattern
    decides, and of equally long ones the list 'allow'. NULL address or day: 'none'. Equal
    captures get equal verdicts; other columns pass through, and columns named verdict
    and rule are replaced. The as-of join runs over distinct (pattern, day), so that a
    site with many captures brings at most one row a day for each of its patterns.
    """
    spans = stage(intervals(entries), "list-intervals")
    asked = stage(
        with_patterns(
            captures.select(F.col(url).alias("__url"), F.col(day).alias("__day"))
            .filter("__url IS NOT NULL AND __day IS NOT NULL")
            .distinct(),
            "__url",
        ).select("__url", "__day", F.explode("__patterns").alias("pattern")),
        "capture-patterns",
    )
    active = (
        asked.select("pattern", "__day")
        .distinct()
        .join(
            spans,
            (asked["pattern"] == spans["pattern"])
            & (F.col("__day") >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (F.col("__day") < F.col("valid_to"))),
        )
        .groupBy(asked["pattern"], "__day")
        .agg(F.max(F.col("list") == "allow").alias("__allow"))
    )
    best = F.max(F.struct(F.length("pattern").alias("n"), "__allow", "pattern"))
    verdicts = (
        asked.join(active, ["pattern", "__day"])
        .groupBy("__url", "__day")
        .agg(best.alias("__best"))
    )
    kept = [c for c in captures.columns if c not in ("verdict", "rule")]
    return (
        captures.select(*kept)
        .join(verdicts, (F.col(url) == F.col("__url")) & (F.col(day) == F.col("__day")), "left")
        .select(
            *kept,
            F.when(F.col("__best").isNull(), "none")
            .when(F.col("__best.__allow"), "allow")
            .otherwise("block")
            .alias("verdict"),
            F.col("__best.pattern").alias("rule"),
        )
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures; the day of the fetch follows from the page's number."""
    return pages.select(
        "page_id", "url", F.expr("date_add(DATE '2024-01-01', cast(page_id * 7 % 365 AS int))").alias("fetched_on")
    )


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list entry from each page: its host, domain, section or address, by the address's digest."""
    host = F.lower(F.regexp_extract("url", _HOST, 1))
    rest = F.regexp_replace(F.regexp_extract("url", _REST, 1), r"#.*$", "")
    digest = F.md5(F.concat_ws("/", "url", "page_id"))
    kind = F.substring(digest, 1, 1)
    section = F.concat(host, F.lit("/"), F.regexp_extract(rest, r"^/+([^/?]+)", 1))
    return pages.filter(F.col("url").isNotNull()).select(
        F.when(F.substring(digest, 2, 1) < "c", "block").otherwise("allow").alias("list"),
        F.when(kind < "4", host)
        .when(kind < "6", F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
        .when(kind < "b", section)
        .otherwise(F.concat(host, rest))
        .alias("pattern"),
        F.when(F.substring(digest, 3, 1) < "8", "add").otherwise("remove").alias("action"),
        F.expr("date_add(DATE '2023-07-01', cast(conv(substring(md5(concat_ws('/', url, page_id)), 4, 4), 16, 10) AS int) % 540)").alias(
            "effective_on"
        ),
    )


#: For `judge_captures` over `captures_of` and `entries_of` the pages.
ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id * 7 % 365)::INTEGER AS fetched_on,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$', 1), '#.*$', '') AS rest,
         md5(concat_ws('/', url, page_id)) AS m
  FROM pages
), e AS (
  SELECT CASE WHEN substr(m, 2, 1) < 'c' THEN 'block' ELSE 'allow' END AS list,
         CASE WHEN m < '4' THEN host WHEN m < '6' THEN regexp_extract(host, '([^.]+\.[^.]+)$', 1)
              WHEN m < 'b' THEN host || '/' || regexp_extract(rest, '^/+([^/?]+)', 1)
              ELSE host || rest END AS pattern,
         substr(m, 3, 1) < '8' AS added,
         DATE '2023-07-01' + (('0x' || substr(m, 4, 4))::INTEGER % 540)::INTEGER AS day
  FROM p WHERE url IS NOT NULL
), days AS (
  SELECT list, pattern, day, bool_or(added) AS added FROM e GROUP BY ALL
), spans AS (
  SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY list, pattern ORDER BY day) AS until FROM days) WHERE added
), labels_of AS (
  SELECT DISTINCT url, fetched_on, host, rest, string_split(host, '.') AS l,
         list_filter(string_split(regexp_replace(rest, '\?.*$', ''), '/'), lambda x: x <> '') AS s
  FROM p WHERE host <> ''
), asked AS (
  SELECT url, fetched_on, unnest(list_distinct(list_concat(
    CASE WHEN len(l) >= 2 THEN list_transform(range(1, len(l)), lambda i: array_to_string(l[i:], '.')) ELSE [host] END,
    list_transform(range(1, len(s) + 1), lambda i: host || '/' || array_to_string(s[:i], '/')),
    [host || rest]))) AS pattern
  FROM labels_of
), found AS (
  SELECT a.url, a.fetched_on, a.pattern, bool_or(s.list = 'allow') AS allow
  FROM asked a JOIN spans s ON a.pattern = s.pattern AND a.fetched_on >= s.day
    AND (s.until IS NULL OR a.fetched_on < s.until)
  GROUP BY ALL
), best AS (
  SELECT * FROM found
  QUALIFY row_number() OVER (PARTITION BY url, fetched_on ORDER BY length(pattern) DESC, allow DESC, pattern DESC) = 1
)
SELECT p.page_id, p.url, p.fetched_on,
       CASE WHEN b.pattern IS NULL THEN 'none' WHEN b.allow THEN 'allow' ELSE 'block' END AS verdict,
       b.pattern AS rule
FROM p LEFT JOIN best b ON p.url = b.url AND p.fetched_on = b.fetched_on
"""
