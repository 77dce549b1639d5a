"""Pages to node arrays: the one step that leaves the JVM.

The work is narrow (no shuffle): every input row yields one row whose ``html``
is replaced by ``nodes``.  All later extraction steps are native expressions
on that array.
"""

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators import markup
from newsloom.schemas import NODE_TYPE

# Executors get the scanner with the task and need no installed copy of it.
cloudpickle.register_pickle_by_value(markup)

# Output batches are cut by input size, so that a batch of large pages does not
# turn into one very large node batch.
_BATCH_CHARS = 4 << 20
_BATCH_ROWS = 1024

_NODE_TYPES = {
    "node_id": pa.int32(),
    "parent_id": pa.int32(),
    "last_id": pa.int32(),
    "within": pa.int32(),
    "tag": pa.string(),
    "attrs": pa.map_(pa.string(), pa.string()),
    "text": pa.string(),
}


def _make_tokeniser(html_col: str):
    scan, types = markup.scan, _NODE_TYPES
    batch_chars, batch_rows = _BATCH_CHARS, _BATCH_ROWS

    def node_column(pages):
        ids, lasts, nodes, row_offsets = [], [], [], [0]
        for html in pages:
            if html:
                found, last = scan(html)
                nodes += found
                lasts += last
                ids += range(len(last))
            row_offsets.append(len(ids))
        parents, within, tags, attrs, texts = zip(*nodes) if nodes else ((),) * 5
        filled = [a for a in attrs if a]
        offsets = accumulate((len(a) if a else 0 for a in attrs), initial=0)
        columns = {
            "node_id": ids,
            "parent_id": parents,
            "last_id": lasts,
            "within": within,
            "tag": tags,
            "text": texts,
        }
        arrays = {name: pa.array(values, types[name]) for name, values in columns.items()}
        arrays["attrs"] = pa.MapArray.from_arrays(
            pa.array(offsets, pa.int32()),
            pa.array([k for a in filled for k in a], pa.string()),
            pa.array([v for a in filled for v in a.values()], pa.string()),
        )
        structs = pa.StructArray.from_arrays([arrays[name] for name in types], list(types))
        return pa.ListArray.from_arrays(pa.array(row_offsets, pa.int32()), structs)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(html_col)
            kept = [i for i in range(batch.num_columns) if i != at]
            names = [batch.schema.names[i] for i in kept] + ["nodes"]
            start = 0
            while start < batch.num_rows:
                pages, chars, stop = [], 0, start
                while stop < batch.num_rows and stop - start < batch_rows and chars < batch_chars:
                    html = batch.column(at)[stop].as_py()
                    pages.append(html)
                    chars += len(html) if html else 0
                    stop += 1
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in kept] + [node_column(pages)], names
                )
                start = stop

    return tokenise


def dom_nodes(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Replace ``html`` by ``nodes``; all other columns pass through.

    Spark bounds the batches it sends by spark.sql.execution.arrow.maxBytesPerBatch.
    """
    others = [f for f in pages.schema.fields if f.name != html_col]
    schema = T.StructType([*others, T.StructField("nodes", NODE_TYPE)])
    return pages.mapInArrow(_make_tokeniser(html_col), schema)


def below(nodes: Column, node: Column) -> Column:
    """All nodes inside ``node``: ids are array positions in document order."""
    return F.slice(nodes, node["node_id"] + 2, node["last_id"] - node["node_id"])


def has(within: Column, mark: int) -> Column:
    return within.bitwiseAND(F.lit(mark)) != 0


def visible_pieces(nodes: Column, node: Column) -> Column:
    """Text pieces inside ``node`` that a reader sees, in order."""
    shown = F.filter(
        below(nodes, node),
        lambda n: (n["tag"] == markup.TEXT) & ~has(n["within"], markup.IN_HIDDEN),
    )
    return F.transform(shown, lambda n: n["text"])


def attribute(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def first_node(nodes: Column, condition) -> Column:
    """First matching node, or NULL; its presence and its attributes are separate."""
    return F.get(F.filter(nodes, condition), F.lit(0))
