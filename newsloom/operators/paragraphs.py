"""Paragraph selection and cleaning."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.operators import markup
from newsloom.operators.dom import attribute, has, visible_pieces
from newsloom.schemas import MIN_PARAGRAPH_CHARS

# Per policy, the enclosing element kinds to try in turn;
# None takes every paragraph.
SELECTORS = {
    "four": (markup.IN_TEXT_BLOCK, markup.IN_ARTICLE, markup.IN_MAIN, markup.IN_RICH_TEXT),
    "three": (markup.IN_ARTICLE, markup.IN_MAIN, None),
}

_FURNITURE = "|".join(markup.FURNITURE_WORDS)


def _inside(paragraphs: Column, mark: int | None) -> Column:
    if mark is None:
        return paragraphs
    return F.filter(paragraphs, lambda p: has(p["within"], mark))


def _first_hit(paragraphs: Column, marks) -> Column:
    # Branches are evaluated in turn, so later selectors cost nothing after a hit.
    hits = F.when(F.size(_inside(paragraphs, marks[0])) > 0, _inside(paragraphs, marks[0]))
    for mark in marks[1:-1]:
        hits = hits.when(F.size(_inside(paragraphs, mark)) > 0, _inside(paragraphs, mark))
    return hits.otherwise(_inside(paragraphs, marks[-1]))


def selected(policy: Column | str, paragraphs: Column) -> Column:
    """Paragraph nodes of the first selector with any hit.

    ``policy`` is a policy name, or a column of names that may differ by row.
    """
    if isinstance(policy, str):
        return _first_hit(paragraphs, SELECTORS[policy])
    out = None
    for name, marks in SELECTORS.items():
        branch = (policy == name, _first_hit(paragraphs, marks))
        out = F.when(*branch) if out is None else out.when(*branch)
    return out


def paragraph_texts(nodes: Column, selector_policy: Column | str) -> Column:
    """Text of the selected paragraphs, each with a mark for page furniture."""

    def read(paragraphs: Column) -> Column:
        return F.transform(
            selected(selector_policy, paragraphs),
            lambda p: F.struct(
                F.array_join(visible_pieces(nodes, p), " ").alias("text"),
                (
                    has(p["within"], markup.IN_FURNITURE)
                    | F.coalesce(F.lower(attribute(p, "class")).rlike(_FURNITURE), F.lit(False))
                ).alias("furniture"),
            ),
        )

    return let(F.filter(nodes, lambda n: n["tag"] == "p"), read)


def with_paragraphs(
    nodes_df: DataFrame, selector_policy: Column | str = "four", out: str = "paragraphs"
) -> DataFrame:
    """Add the selected paragraphs with their text."""
    return nodes_df.withColumn(out, paragraph_texts(F.col("nodes"), selector_policy))


def clean_join(paragraphs: Column) -> Column:
    """Drop short paragraphs and page furniture; join the rest by blank lines.

    Text pieces are stripped when they are read, so the result needs no trim.
    """
    kept = F.filter(
        paragraphs,
        lambda p: (F.length(p["text"]) >= MIN_PARAGRAPH_CHARS) & ~p["furniture"],
    )
    return F.array_join(F.transform(kept, lambda p: p["text"]), "\n\n")


def clean_paragraphs(
    nodes_df: DataFrame, selector_policy: Column | str = "four", out: str = "paragraph_text"
) -> DataFrame:
    """Add the cleaned text of the selected paragraphs; empty when there is none."""
    return nodes_df.withColumn(
        out, clean_join(paragraph_texts(F.col("nodes"), selector_policy))
    )
