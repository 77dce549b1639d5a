"""Main text of pages by a style tree for each site.

The elements of a host's pages are merged by their style path (tags and names from the
root). A node's presentation importance is the entropy of its children's tags over the pages
(a fixed frame has none); a leaf's content importance is one less the entropy of its text over
the pages that have the leaf (the same text on every page has none). An inner node's
importance is made of its presentation and the mean importance of all text below it, so
importance is summed up the tree. Branches of low importance are removed from each page
with all that is in them, changing text included, and so are single texts of low importance.
"""

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.page_blocks import blocks_of
from newsloom.llm.workers import release, with_code
from newsloom.sources.staging import stage

#: Share of a block's own content in its importance; the rest is its parent's.
CONTENT_SHARE = 0.9
LEAST_IMPORTANCE = 0.1
#: With fewer pages a leaf's text tells nothing about the site.
LEAST_PAGES = 8

_BLOCK = pa.struct(
    [
        ("node", pa.int64()),
        ("parent", pa.int64()),
        ("feature", pa.int64()),
        ("branches", pa.list_(pa.int64())),
        ("text", pa.string()),
    ]
)
_STYLE = pa.struct([("node", pa.int64()), ("style", pa.int64())])
_SCHEMA = (
    "__row bigint, __blocks array<struct<node: bigint, parent: bigint, feature: bigint, branches: array<bigint>, text: string>>,"
    " __styles array<struct<node: bigint, style: bigint>>"
)


def parsed_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with a number for the row, its blocks and its styles."""
    columns = [c for c in pages.columns if c != html]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                blocks, styles = [], []
                for text in part.column(part.num_columns - 1).to_pylist():
                    found, seen = blocks_of(text or "")
                    blocks.append([b._asdict() for b in found])
                    styles.append([{"node": n, "style": s} for n, s in seen])
                rows = range(row, row + part.num_rows)
                row += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.array(rows, pa.int64()),
                        pa.array(blocks, pa.list_(_BLOCK)),
                        pa.array(styles, pa.list_(_STYLE)),
                    ],
                    [*columns, "__row", "__blocks", "__styles"],
                )
        release()

    narrow = with_code(pages.select(*columns, html))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != html]
    return narrow.mapInArrow(run, ", ".join([*fields, _SCHEMA]))


def importance(parsed: DataFrame, host: str) -> tuple[DataFrame, DataFrame]:
    """Importance of leaf texts and of branches, over the pages of each host; both staged.

    ``host, node, feature, with_text, pages, importance`` and ``host, node, pages, importance``.
    Counts are summed where the pages are before they are shuffled; one page counts once
    for a leaf's text, for a node and for a node's style. The text that lies directly in a
    node is a leaf of its own.
    """
    blocks = parsed.select("__row", F.col(host).alias("host"), F.explode("__blocks").alias("b")).select(
        "host", "__row", "b.node", "b.parent", "b.feature", "b.branches"
    )
    # One page is one row, so a page's repeats are dropped before anything is moved.
    leaf = parsed.select(
        F.col(host).alias("host"),
        F.explode(
            F.array_distinct(F.transform("__blocks", lambda b: F.struct(b["node"], b["parent"], b["feature"])))
        ).alias("b"),
    ).select("host", "b.*")
    texts = leaf.groupBy("host", "node", "parent", "feature").agg(F.count("*").alias("with_text"))
    nodes = parsed.select(
        F.col(host).alias("host"),
        F.explode(F.array_distinct(F.transform("__blocks", lambda b: b["node"]))).alias("node"),
    )
    pages = nodes.groupBy("host", "node").agg(F.count("*").alias("pages"))
    styles = (
        parsed.select(F.col(host).alias("host"), F.explode("__styles").alias("s"))
        .groupBy("host", "s.node", "s.style")
        .agg(F.count("*").alias("n"))
        .groupBy("host", "node")
        .agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    )
    presentation = stage(
        styles.select(
            "host",
            "node",
            F.when(F.col("m") > 1, (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m"))
            .otherwise(F.lit(1.0))
            .alias("presentation"),
        ),
        "presentation",
    )
    content = F.when(F.col("pages") > 1, 1 - F.log("with_text") / F.log("pages")).otherwise(F.lit(1.0))
    of_parent = presentation.withColumnRenamed("node", "parent")
    leaves = stage(
        texts.join(pages, ["host", "node"])
        .join(of_parent, ["host", "parent"], "left")
        .select(
            "host", "node", "feature", "with_text", "pages",
            (CONTENT_SHARE * content + (1 - CONTENT_SHARE) * F.coalesce("presentation", F.lit(1.0))).alias("importance"),
        ),
        "leaves",
    )
    below = leaves.groupBy("host", "node").agg(
        F.sum(F.col("with_text") * F.col("importance")).alias("sum"), F.sum("with_text").alias("n")
    )
    # A node's hash stands for its path, so its branches are the same wherever it occurs.
    paths = blocks.groupBy("host", "node").agg(F.max("branches").alias("branches"))
    on_pages = parsed.select(
        F.col(host).alias("host"),
        F.explode(
            F.array_distinct(F.flatten(F.transform("__blocks", lambda b: F.concat(b["branches"], F.array(b["node"])))))
        ).alias("node"),
    ).groupBy("host", "node").agg(F.count("*").alias("pages"))
    summed = (
        below.join(paths, ["host", "node"])
        .select("host", F.explode(F.concat("branches", F.array("node"))).alias("node"), "sum", "n")
        .groupBy("host", "node")
        .agg((F.sum("sum") / F.sum("n")).alias("mean"))
    )
    branches = stage(
        summed.join(presentation, ["host", "node"], "left")
        .join(on_pages, ["host", "node"])
        .select(
            "host", "node", "pages",
            (CONTENT_SHARE * F.col("mean") + (1 - CONTENT_SHARE) * F.coalesce("presentation", F.lit(1.0))).alias("importance"),
        ),
        "branches",
    )
    return leaves, branches


def unimportant(parsed: DataFrame, host: str) -> tuple[DataFrame, DataFrame]:
    """``host, node, feature`` of leaf texts, and ``host, node`` of branches, below the threshold."""
    leaves, branches = importance(parsed, host)
    low = (F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LEAST_IMPORTANCE)
    # Even below a parent of no importance, a text must recur this much to go.
    recurs = F.col("with_text") > F.pow("pages", F.lit(1 - LEAST_IMPORTANCE / CONTENT_SHARE))
    texts = leaves.filter(low & (F.col("with_text") > 1) & recurs)
    return texts.select("host", "node", "feature"), branches.filter(low).select("host", "node")


def extract_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with ``text`` (blocks joined by line feeds) and ``n_chars``.

    NULL or empty html gives an empty text. Pages without a readable host are a site of
    their own for furniture, but nothing is compared. A page all of whose blocks recur is
    a copy and keeps them. Repeated rows count as pages and are returned each; other
    columns pass through, and columns named text and n_chars are replaced.
    """
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    sited = pages.select(*kept, F.nullif(host, F.lit("")).alias("__host"), html)
    parsed = stage(parsed_pages(sited, html), "page-blocks")
    known = parsed.filter("__host IS NOT NULL")
    # A host's lists are short: what is of low importance is on many of its pages.
    texts, branches = unimportant(known, "__host")
    keys = texts.select("host", F.xxhash64("node", "feature").alias("text"), F.lit(None).cast("bigint").alias("branch"))
    both = keys.unionByName(branches.select("host", F.lit(None).cast("bigint").alias("text"), F.col("node").alias("branch")))
    low = stage(
        both.groupBy(F.col("host").alias("__site")).agg(
            F.collect_list("text").alias("__texts"), F.collect_list("branch").alias("__branches")
        ),
        "low-importance",
    )
    rest = F.filter(
        "__blocks",
        lambda b: ~F.array_contains(F.col("__texts"), F.xxhash64(b["node"], b["feature"]))
        & ~F.arrays_overlap(F.col("__branches"), F.concat(b["branches"], F.array(b["node"]))),
    )
    left = F.when(F.col("__site").isNull() | (F.size(rest) == 0), F.col("__blocks")).otherwise(rest)
    text = F.array_join(F.transform(left, lambda b: b["text"]), "\n")
    return (
        parsed.join(low, F.col("__host") == F.col("__site"), "left")
        .select(*kept, text.alias("text"))
        .withColumn("n_chars", F.length("text").cast("bigint"))
    )
