"""Text, tag-list and identity expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.schemas import ID_CHARS

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``.

    Higher-order functions are evaluated without common-subexpression
    elimination, so a repeated sub-expression would be computed repeatedly.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_space(text: Column) -> Column:
    """Trim all Unicode white space (``F.trim`` only knows U+0020)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def tag_list(keywords: Column) -> Column:
    """``"A, ,b"`` -> ``"a, b"``; NULL when nothing is left. Order and repeats stay."""
    pieces = F.transform(F.split(keywords, ","), lambda t: F.lower(strip_space(t)))
    joined = F.array_join(F.filter(pieces, lambda t: t != ""), ", ")
    return F.nullif(joined, F.lit(""))


def article_id(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, ID_CHARS)


def content_hash(title: Column, content: Column, hash_chars: int | None = None) -> Column:
    """SHA-1 over the title and the whole body.

    ``hash_chars`` cuts the body; only for stores whose hashes were made that way
    (with 4000 characters).
    """
    body = content if hash_chars is None else F.substring(content, 1, hash_chars)
    return F.sha1(F.concat(F.coalesce(title, F.lit("")), F.lit("|"), body))
