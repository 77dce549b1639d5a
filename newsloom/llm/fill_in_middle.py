"""Fill-in-the-middle: a text is cut in three by counted quantifiers and put together anew.

``regexp_count`` gives the number n of units of a text. Two numbers from a hash of the
document's id, taken modulo n + 1, say after how many units the prefix ends (a, the
smaller) and the middle (b). A pattern made for the row, with the possessive groups
``unit{a}`` and ``unit{b - a}``, takes prefix, middle and suffix in one match, and its
replacement writes them out in their new order. Possessive quantifiers over one unit run
as loops in the JVM, so a long text needs neither stack nor backtracking.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One code point, line feeds included.
CODE_POINT = "(?s:.)"
#: Of a hundred texts, how many are cut, and how many of those get the suffix first.
CUT_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20
_RUN = 4096


def count_units(text: Column, unit: str = CODE_POINT) -> Column:
    """Number of units of a text.

    Whole runs of 4,096 units are counted first and then the units that are left: counting
    matches makes a list of them, which would hold an entry for each unit of the text.
    """
    run = F.lit(f"(?:{unit}){{{_RUN}}}+")
    rest = F.regexp_replace(text, run, F.lit(""))
    return (F.regexp_count(text, run) * _RUN + F.regexp_count(rest, F.lit(unit))).cast("bigint")


def _draw(digest: Column, i: int) -> Column:
    """The i-th group of eight hex digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint")


def _literal(text: str) -> str:
    """``text`` as it must stand in a replacement."""
    return re.sub(r"([\\$])", r"\\\1", text)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = CODE_POINT,
    seed: int = 1,
    cut_percent: int = CUT_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """``id, text, n_units, form, prefix_units, middle_units, output`` of every document.

    ``unit`` is a pattern whose matches stand one after another from a text's first to its
    last character. ``form`` is ``psm`` (output: <P>prefix<S>suffix<M>middle), ``spm``
    (<S>suffix<P>prefix<M>middle) or ``plain`` (output: the text); both counts are NULL for
    the last. Plain are empty texts, texts that hold one of the three marks, and those that
    the draw leaves. NULL counts as the empty text and a NULL id as one without digits.
    Equal rows give equal results, each its own. Other columns of ``docs`` are not carried,
    so their names can't clash; an empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    counted = base.select("id", "text", count_units(F.col("text"), unit).alias("n_units"), digest.alias("digest"))
    h1, h2, h3, h4 = (_draw(F.col("digest"), i) for i in range(4))
    first, second = h1 % (F.col("n_units") + 1), h2 % (F.col("n_units") + 1)
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    form = (
        F.when((F.col("text") == "") | marked | (h3 % 100 >= cut_percent), "plain")
        .when(h4 % 100 < suffix_first_percent, "spm")
        .otherwise("psm")
    )
    placed = counted.select(
        "id", "text", "n_units", form.alias("form"), F.least(first, second).alias("a"), F.greatest(first, second).alias("b")
    )
    cut = F.col("form") != "plain"
    pattern = F.concat(
        F.lit(rf"\A((?:{unit}){{"), F.col("a"), F.lit(rf"}}+)((?:{unit}){{"), F.col("b") - F.col("a"), F.lit(r"}+)((?s:.)*+)\z")
    )
    p, s, m = map(_literal, (PREFIX, SUFFIX, MIDDLE))
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    return placed.select(
        F.col("id").alias(id_col),
        F.col("text").alias(text_col),
        "n_units",
        "form",
        F.when(cut, F.col("a")).alias("prefix_units"),
        F.when(cut, F.col("b") - F.col("a")).alias("middle_units"),
        F.when(cut, F.regexp_replace("text", pattern, order)).otherwise(F.col("text")).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text, rebuilt from output and form alone.

    A cut text holds no mark, and no mark can arise where a piece meets one, so the first
    mark of each kind is the one that was put in.
    """
    p, s, m = map(re.escape, (PREFIX, SUFFIX, MIDDLE))
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


#: The same rows without patterns.
ORACLE_SQL = f"""
WITH counted AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, n, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                OR ('0x' || h[17:24])::BIGINT % 100 >= {CUT_PERCENT} THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < {SUFFIX_FIRST_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM counted),
cut AS (
  SELECT *, least(x, y) AS a, greatest(x, y) AS b, substring(text, 1, least(x, y)) AS prefix,
         substring(text, least(x, y) + 1, abs(x - y)) AS middle, substring(text, greatest(x, y) + 1) AS suffix
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut"""
