"""Main block of a page by paragraph scores.

Each paragraph scores its parent in full and its grandparent by half: one
point, one per comma, and up to three for length.  A container's sum is
weighted by its tag and class words and by the share of text outside links.

An article may be split over neighbouring containers, so the scores of all containers of
a page are kept: the siblings of the best one that reach a fifth of its score belong
to the main block, as do longer paragraphs beside it that are not mostly links.

Everything stays inside the row: the contributions of a page are sorted by
container and summed run by run, so the cost is n log n in the page's size and no
shuffle is needed.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.operators import markup
from newsloom.operators.dom import attribute, below, has

# Scores are whole numbers in hundredths of half a point, so sums are exact.
_POINT = 200
_MIN_CHARS = 25
_MAX_LENGTH_POINTS = 3
_TAG_POINTS = {"article": 10, "main": 8, "div": 5, "section": 3, "blockquote": 3,
               "ul": -3, "ol": -3, "form": -3, "li": -3}
_CLASS_POINTS = 25
# A sibling of the best container needs this share of its score, a bare paragraph this length.
_SIBLING_SHARE = 0.2
_SIBLING_CHARS = 80
_GOOD_CLASS = r"(?i)article|body|content|entry|main|post|story|text"
_BAD_CLASS = r"(?i)advert|banner|comment|footer|menu|nav|promo|related|share|sidebar|sponsor|widget"

_SCORED_TAGS = ("p", "pre", "td")


def _paragraph_scores(nodes: Column) -> Column:
    def stats(p: Column) -> Column:
        inner = F.filter(
            below(nodes, p),
            lambda n: (n["tag"] == markup.TEXT) & ~has(n["within"], markup.IN_HIDDEN),
        )
        text = F.array_join(F.transform(inner, lambda n: n["text"]), " ")
        linked = F.array_join(
            F.transform(F.filter(inner, lambda n: has(n["within"], markup.IN_LINK)),
                        lambda n: n["text"]),
            " ",
        )
        return let(
            text,
            lambda t: F.struct(
                p["parent_id"].alias("parent"),
                F.get(nodes, p["parent_id"])["parent_id"].alias("grandparent"),
                F.length(t).cast("long").alias("chars"),
                F.length(linked).cast("long").alias("link_chars"),
                (
                    F.lit(_POINT)
                    + F.regexp_count(t, F.lit("[,،、，]")) * _POINT
                    + F.least(F.length(t) * 2, F.lit(_MAX_LENGTH_POINTS * _POINT))
                )
                .cast("long")
                .alias("score"),
            ),
        )

    blocks = F.filter(
        nodes,
        lambda n: n["tag"].isin(*_SCORED_TAGS)
        & ~has(n["within"], markup.IN_FURNITURE | markup.IN_HIDDEN),
    )
    return F.filter(F.transform(blocks, stats), lambda s: s["chars"] >= _MIN_CHARS)


def _contributions(scores: Column) -> Column:
    def give(s: Column, to: str, halves: int) -> Column:
        return F.struct(
            s[to].alias("container"),
            F.floor(s["score"] * halves / 2).cast("long").alias("score"),
            s["chars"].alias("chars"),
            s["link_chars"].alias("link_chars"),
        )

    both = F.transform(
        scores, lambda s: F.array(give(s, "parent", 2), give(s, "grandparent", 1))
    )
    owned = F.filter(F.flatten(both), lambda c: c["container"] >= 0)
    return F.array_sort(owned)


def _weight(container: Column) -> Column:
    tag_points = F.lit(0)
    for tag, points in _TAG_POINTS.items():
        tag_points = F.when(container["tag"] == tag, F.lit(points)).otherwise(tag_points)
    names = F.concat_ws(" ", attribute(container, "class"), attribute(container, "id"))
    return (
        tag_points
        + F.when(names.rlike(_GOOD_CLASS), _CLASS_POINTS).otherwise(0)
        - F.when(names.rlike(_BAD_CLASS), _CLASS_POINTS).otherwise(0)
    ) * _POINT


def container_scores(nodes: Column) -> Column:
    """``container, score, parent`` of every container with a scored paragraph, by container."""

    def score(run: Column) -> Column:
        """The contributions to one container, summed."""

        def total(field: str) -> Column:
            return F.aggregate(run, F.lit(0).cast("long"), lambda s, c: s + c[field])

        node = F.get(nodes, F.get(run, F.lit(0))["container"])
        share = F.lit(1.0) - total("link_chars") / F.greatest(total("chars"), F.lit(1).cast("long"))
        return let(
            node,
            lambda n: F.struct(
                n["node_id"].alias("container"),
                ((total("score") + _weight(n)) * share).cast("double").alias("score"),
                n["parent_id"].alias("parent"),
            ),
        )

    def runs(given: Column) -> Column:
        count = F.size(given)
        places = F.filter(
            F.transform(given, lambda _, i: i),
            lambda i: (i == 0) | (F.get(given, i)["container"] != F.get(given, i - 1)["container"]),
        )
        return let(
            places,
            lambda starts: F.transform(
                starts,
                lambda start, i: F.slice(given, start + 1, F.coalesce(F.get(starts, i + 1), count) - start),
            ),
        )

    return let(let(_contributions(_paragraph_scores(nodes)), runs), lambda rs: F.transform(rs, score))


def _best(scores: Column) -> Column:
    """The container with the greatest score, the first of several; NULL if there is none."""
    ranked = F.transform(scores, lambda s: F.struct(s["score"], (-s["container"]).alias("before"), s["parent"]))
    return F.array_max(ranked)


def best_container(nodes: Column) -> Column:
    """Node id of the best scored container; NULL if no paragraph scores."""
    return -_best(container_scores(nodes))["before"]


def main_blocks(nodes: Column) -> Column:
    """Node ids of the main block's containers in document order; NULL if no paragraph scores."""

    def around(best: Column, scores: Column) -> Column:
        near = F.filter(
            scores,
            lambda s: (s["parent"] == best["parent"])
            & (s["score"] >= F.greatest(best["score"] * _SIBLING_SHARE, F.lit(0.0))),
        )
        chosen = F.transform(near, lambda s: s["container"])
        beside = F.filter(
            F.coalesce(let(F.get(nodes, best["parent"]), lambda p: below(nodes, p)), nodes),
            lambda n: (n["parent_id"] == best["parent"])
            & (n["tag"] == "p")
            & ~has(n["within"], markup.IN_FURNITURE | markup.IN_HIDDEN),
        )
        own = F.filter(F.transform(beside, lambda p: _paragraph(nodes, p)), _is_prose)
        ids = F.concat(chosen, F.array(-best["before"]), F.transform(own, lambda p: p["node_id"]))
        return F.array_sort(F.array_distinct(ids))

    return let(
        container_scores(nodes), lambda scores: let(_best(scores), lambda b: F.when(b.isNotNull(), around(b, scores)))
    )


def _paragraph(nodes: Column, p: Column) -> Column:
    """Length of a paragraph's text, and of that in links."""
    inner = F.filter(
        below(nodes, p), lambda n: (n["tag"] == markup.TEXT) & ~has(n["within"], markup.IN_HIDDEN)
    )

    def chars(texts: Column) -> Column:
        return F.aggregate(texts, F.lit(0), lambda s, n: s + F.length(n["text"]))

    return F.struct(
        p["node_id"].alias("node_id"),
        chars(inner).alias("chars"),
        chars(F.filter(inner, lambda n: has(n["within"], markup.IN_LINK))).alias("link_chars"),
    )


def _is_prose(p: Column) -> Column:
    return (p["chars"] >= _SIBLING_CHARS) & (p["link_chars"] * 4 < p["chars"])


def _whole_text(nodes: Column) -> Column:
    """Visible text of the article, main part or body, for pages in which no paragraph scores."""

    def first(tag: str) -> Column:
        return F.get(F.filter(nodes, lambda n: n["tag"] == tag), F.lit(0))

    body = F.coalesce(first("article"), first("main"), first("body"))
    inside = F.coalesce(let(body, lambda b: F.when(b.isNotNull(), below(nodes, b))), nodes)
    kept = F.filter(
        inside,
        lambda n: (n["tag"] == markup.TEXT)
        & ~has(n["within"], markup.IN_FURNITURE | markup.IN_HIDDEN)
        & F.coalesce(F.get(nodes, n["parent_id"])["tag"] != "title", F.lit(True)),
    )
    return F.array_join(F.transform(kept, lambda n: n["text"]), " ")


def main_text(nodes: Column) -> Column:
    """Visible text of the main block, else of the article, main part or body."""

    def read(container: Column) -> Column:
        return F.filter(
            below(nodes, container),
            lambda n: (n["tag"] == markup.TEXT)
            & ~has(n["within"], markup.IN_FURNITURE | markup.IN_HIDDEN),
        )

    def joined(blocks: Column) -> Column:
        texts = F.flatten(F.transform(blocks, lambda b: read(F.get(nodes, b))))
        return F.when(blocks.isNotNull(), F.array_join(F.transform(texts, lambda n: n["text"]), " "))

    return F.coalesce(let(main_blocks(nodes), joined), _whole_text(nodes))


def main_content(nodes_df: DataFrame, out: str = "main_text") -> DataFrame:
    return nodes_df.withColumn(out, main_text(F.col("nodes")))
