"""Quality rules whose cutoffs are set by labelled holdouts, with a bound on false rejections.

Counts and rules are DataFrame expressions only.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.sources.staging import stage

BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"

#: Of all good documents of a stratum, at most this share may be rejected ...
MAX_FALSE_REJECTION = 0.02
#: ... with this probability of being wrong about any stratum, rule or cutoff.
ERROR = 0.05


@dataclass(frozen=True)
class Rule:
    """Reject if scale * num / den, rounded down, exceeds a cutoff: 0, step, ... step * (cutoffs - 1)."""

    name: str
    num: str
    den: str
    scale: int
    step: int
    cutoffs: int

    def bin(self) -> Column:
        """Number of cutoffs that the value exceeds."""
        value = F.expr(f"({self.scale} * `{self.num}`) div nullif(`{self.den}`, 0)")
        over = F.expr(f"({self.scale} * `{self.num}` div nullif(`{self.den}`, 0) + {self.step - 1}) div {self.step}")
        return F.when(value.isNull(), 0).otherwise(F.least(over, F.lit(self.cutoffs))).cast("int")


RULES = (
    Rule("symbols", "n_symbols", "word_chars", 1000, 10, 50),
    Rule("dup_lines", "n_dup_lines", "n_lines", 1000, 20, 50),
    Rule("repeats", "n_repeat_words", "n_words", 1000, 20, 50),
    Rule("word_length", "word_chars", "n_words", 10, 5, 50),
)


def _repeat_words(words: str) -> Column:
    """Words in 3-word windows found more than once.

    A window's hash and position are packed into one number (the position takes as many
    bits as the text needs), so that one sort of plain numbers brings equal windows
    together.
    """
    windows = f"""transform(sequence(0, size({words}) - 3),
        i -> shiftleft(xxhash64(get({words}, i), get({words}, i + 1), get({words}, i + 2)), __bits) | i)"""
    found = f"CASE WHEN size({words}) >= 3 THEN sort_array({windows}) END"
    return F.expr(found)


def _repeated_positions(packed: str) -> Column:
    key = "shiftright({}, __bits)"
    same = f"""(j > 0 AND {key.format(f"get({packed}, j - 1)")} = {key.format(f"get({packed}, j)")})
        OR (j + 1 < size({packed}) AND {key.format(f"get({packed}, j + 1)")} = {key.format(f"get({packed}, j)")})"""
    picked = f"filter(sequence(0, size({packed}) - 1), j -> {same})"
    return F.expr(
        f"""CASE WHEN size({packed}) > 1 THEN sort_array(
            transform({picked}, j -> get({packed}, j) & (shiftleft(1L, __bits) - 1))) END"""
    )


def _covered(positions: str) -> Column:
    """Words of windows that begin at the sorted positions."""
    gaps = f"""aggregate(sequence(0, size({positions}) - 2), 0L,
        (n, j) -> n + least(3L, get({positions}, j + 1) - get({positions}, j)))"""
    return F.expr(
        f"""CASE WHEN coalesce(size({positions}), 0) < 1 THEN 0L
            WHEN size({positions}) = 1 THEN 3L ELSE 3L + {gaps} END"""
    )


def text_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """``keep`` and the counts n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    NULL text has no words and no lines. Names in ``keep`` that clash with the counts
    are refused.
    """
    taken = {"n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"}
    if taken & set(keep):
        raise ValueError(f"these columns are counts: {sorted(taken & set(keep))}")
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(NOT_BLANK))
    split = (
        docs.select(*keep, body.alias("__text"))
        .withColumn("__words", F.array_remove(F.split("__text", BLANK), ""))
        .withColumn("__lines", lines)
        .withColumn("__bits", F.expr("length(bin(greatest(size(__words), 1)))"))
    )
    counted = split.select(
        *keep,
        F.size("__words").cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        (F.length("__text") - F.length(F.regexp_replace("__text", SYMBOL, "")))
        .cast("bigint")
        .alias("n_symbols"),
        F.size("__lines").cast("bigint").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        "__bits",
        _repeat_words("__words").alias("__packed"),
    )
    found = counted.withColumn("__at", _repeated_positions("__packed")).drop("__packed")
    return found.withColumn("n_repeat_words", _covered("__at")).drop("__at", "__bits")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def allowed_rejections(strata: DataFrame, share: float, tests_per_stratum: int, error: float) -> DataFrame:
    """``stratum, n`` with ``allowed``: the largest k with P(X <= k) <= error / tests for X binomial in (n, share).

    If k or fewer of n good documents are rejected, the exact (Clopper-Pearson) upper
    bound on the share of good documents that a cutoff rejects is at most ``share``. All
    tests are counted (Bonferroni): strata times ``tests_per_stratum``. -1: no count is
    low enough. Terms are summed up to the mean, which every allowed k lies below.
    """
    tests = strata.agg(F.count("*").alias("__strata"))
    up_to = Window.partitionBy("stratum").orderBy("__i").rowsBetween(Window.unboundedPreceding, 0)
    terms = strata.select(
        "stratum", "n", F.expr(f"explode(sequence(0, cast(floor(n * {share}D) AS int)))").alias("__i")
    ).withColumn(
        "__step",
        F.expr(
            f"""CASE WHEN __i = 0 THEN n * ln(1D - {share}D)
            ELSE ln((n - __i + 1) / __i) + ln({share}D / (1D - {share}D)) END"""
        ),
    )
    sums = terms.withColumn("__log", F.sum("__step").over(up_to)).withColumn(
        "__cdf", F.sum(F.exp("__log")).over(up_to)
    )
    # One row, so that this is a join with a constant.
    within = F.col("__cdf") * F.col("__strata") * tests_per_stratum <= F.lit(error)
    return (
        sums.join(F.broadcast(tests))
        .groupBy("stratum", "n")
        .agg(F.coalesce(F.max(F.when(within, F.col("__i"))), F.lit(-1)).alias("allowed"))
    )


def cutoffs(
    counted: DataFrame,
    good: DataFrame,
    stratum: str,
    rules: tuple[Rule, ...] = RULES,
    share: float = MAX_FALSE_REJECTION,
    error: float = ERROR,
) -> DataFrame:
    """One row for each stratum with good documents: ``stratum`` and a column for each rule.

    ``good``: ``doc_id`` of the labelled good documents. The false rejections allowed are
    split evenly among the rules, so that all rules together keep within ``share``. Each
    rule takes the lowest cutoff of its fixed list that rejects no more good holdout
    documents of the stratum than `allowed_rejections`; NULL if none does (the rule is
    then off), as in strata with too few labels.
    """
    held = counted.filter(~base_failed()).join(good, "doc_id", "left_semi")
    bins = F.array(
        *(F.struct(F.lit(r.name).alias("rule"), r.bin().alias("bin")) for r in rules)
    )
    by_bin = stage(
        held.select(F.col(stratum).alias("stratum"), F.explode(bins).alias("b"))
        .groupBy("stratum", "b.rule", "b.bin")
        .agg(F.count("*").alias("docs")),
        "rule-bins",
    )
    first = rules[0].name
    strata = by_bin.filter(F.col("rule") == first).groupBy("stratum").agg(F.sum("docs").alias("n"))
    tests = sum(r.cutoffs for r in rules)
    allowed = allowed_rejections(strata, share / len(rules), tests, error)
    above = (
        Window.partitionBy("stratum", "rule")
        .orderBy(F.desc("bin"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # Cutoff g rejects bins above g; the lowest that is allowed is the last bin whose
    # documents, with those above it, are too many to reject.
    return (
        by_bin.withColumn("from_here", F.sum("docs").over(above))
        .join(
            allowed.select(F.col("stratum").alias("__stratum"), "allowed"),
            F.col("stratum").eqNullSafe(F.col("__stratum")),
        )
        .groupBy("stratum")
        .agg(
            *(
                F.when(
                    F.max("allowed") >= 0,
                    F.coalesce(
                        F.max(
                            F.when(
                                (F.col("rule") == r.name) & (F.col("from_here") > F.col("allowed")),
                                F.col("bin"),
                            )
                        ),
                        F.lit(0),
                    ),
                ).alias(f"__cut_{r.name}")
                for r in rules
            )
        )
        .select(
            "stratum",
            *(
                F.when(F.col(f"__cut_{r.name}") < r.cutoffs, F.col(f"__cut_{r.name}")).alias(r.name)
                for r in rules
            ),
        )
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: tuple[Rule, ...] = RULES,
    share: float = MAX_FALSE_REJECTION,
    error: float = ERROR,
) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row of ``docs`` (doc_id, text and the stratum).

    Good documents are labelled of high quality and not toxic in every row of
    ``labels``; NULL labels do not count. A stratum without a cutoff for a rule rejects
    nothing by it; NULL is a stratum. NULL and empty texts fail the base rules. Equal rows
    are judged alike; an empty table gives no row.
    """
    counted = stage(text_counts(docs, keep=("doc_id", stratum)), "rule-counts")
    good = labels.groupBy("doc_id").agg(
        (F.min(F.coalesce("quality", F.lit(0))) == 1).alias("__high"),
        (F.max(F.coalesce("toxic", F.lit(1))) == 0).alias("__clean"),
    ).filter("__high AND __clean")
    cut = stage(cutoffs(counted, good, stratum, rules, share, error), "rule-cutoffs")
    fails = F.lit(False)
    for r in rules:
        fails = fails | F.coalesce(r.bin() > F.col(f"__cut.{r.name}"), F.lit(False))
    return (
        counted.alias("d")
        .join(cut.select("stratum", F.struct(*(r.name for r in rules)).alias("__cut")),
              F.col(stratum).eqNullSafe(F.col("stratum")), "left")
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                base_failed().alias("base_failed"), (~base_failed() & ~fails).alias("kept"))
    )


def _oracle_bin(rule: Rule) -> str:
    return (
        f"CASE WHEN {rule.den} = 0 THEN 0 ELSE least({rule.cutoffs}, "
        f"({rule.scale} * {rule.num} // {rule.den} + {rule.step - 1}) // {rule.step}) END"
    )


def _oracle(rules: tuple[Rule, ...], share: float, error: float) -> str:
    part = share / len(rules)
    tests = sum(r.cutoffs for r in rules)
    bins = " UNION ALL ".join(
        f"SELECT r, lang, '{r.name}' AS rule, {_oracle_bin(r)} AS bin FROM held" for r in rules
    )
    tops = " ".join(f"WHEN '{r.name}' THEN {r.cutoffs}" for r in rules)
    fails = " OR ".join(
        f"coalesce({_oracle_bin(r)} > (SELECT cut FROM cuts WHERE cuts.lang IS NOT DISTINCT FROM c.lang AND rule = '{r.name}'), false)"
        for r in rules
    )
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang,
         regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w,
         length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l
  FROM documents
), tri AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS k
  FROM d, unnest(range(1, len(w) - 1)) AS u(i)
), rep AS (
  SELECT r, count(DISTINCT i + o) AS n FROM tri, (VALUES (0), (1), (2)) AS v(o) WHERE k > 1 GROUP BY r
), c AS (
  SELECT d.r, doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
         len(w) < 50 OR 100 * coalesce(rep.n, 0) > 50 * len(w) AS base_failed
  FROM d LEFT JOIN rep ON d.r = rep.r
), good AS (
  SELECT doc_id FROM labels GROUP BY doc_id
  HAVING min(coalesce(quality, 0)) = 1 AND max(coalesce(toxic, 1)) = 0
), held AS (
  SELECT * FROM c WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)
), bins AS ({bins}
), by_bin AS (
  SELECT lang, rule, bin, sum(count(*)) OVER (PARTITION BY lang, rule ORDER BY bin DESC) AS from_here
  FROM bins GROUP BY lang, rule, bin
), strata AS (
  SELECT lang, count(*) AS n FROM held GROUP BY lang
), terms AS (
  SELECT lang, n, i, CASE WHEN i = 0 THEN n * ln(1 - {part}::DOUBLE)
    ELSE lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({part}::DOUBLE) + (n - i) * ln(1 - {part}::DOUBLE) END AS lp
  FROM strata, unnest(range(0, floor(n * {part}::DOUBLE)::BIGINT + 1)) AS u(i)
), cdf AS (
  SELECT lang, i, sum(exp(lp)) OVER (PARTITION BY lang ORDER BY i) AS p FROM terms
), allowed AS (
  SELECT lang, coalesce(max(i) FILTER (p * (SELECT count(*) FROM strata) * {tests} <= {error}), -1) AS k FROM cdf GROUP BY lang
), cuts AS (
  SELECT b.lang, b.rule, CASE WHEN any_value(k) >= 0
    AND coalesce(max(bin) FILTER (from_here > k), 0) < CASE b.rule {tops} END
    THEN coalesce(max(bin) FILTER (from_here > k), 0) END AS cut
  FROM by_bin b JOIN allowed a ON b.lang IS NOT DISTINCT FROM a.lang GROUP BY b.lang, b.rule
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({fails}) AS kept
FROM c
"""


#: For `judge` over documents and labels, by language.
ORACLE_SQL = _oracle(RULES, MAX_FALSE_REJECTION, ERROR)
