"""Small page builders for the fixture tests."""

from pyspark.sql import functions as F

from newsloom.operators.dom import dom_nodes
from newsloom.operators.metadata import with_metadata


def pages(spark, *htmls, urls=None):
    rows = [
        (i, urls[i] if urls else f"http://x.com/{i}/", html) for i, html in enumerate(htmls)
    ]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def meta(spark, *htmls, urls=None):
    return with_metadata(dom_nodes(pages(spark, *htmls, urls=urls)))


def column(df, name, by="page_id"):
    return [r[0] for r in df.orderBy(by).select(F.col(name)).collect()]
