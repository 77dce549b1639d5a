"""URL normalisation and source names as native column expressions.

``parse_url`` is not used: it raises on blanks and ``|``.  Maps are avoided
too, since they refuse repeated query keys.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let

# Query keys that only track where a reader came from.
TRACKING_KEYS = (
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "at_medium",
    "at_campaign",
    "at_custom1",
    "ns_mchannel",
    "ns_source",
    "ns_campaign",
)

# Schemes with ``;params`` and with an authority, as Python's
# urllib lists them.
_PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
    "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
)
_AUTHORITY_SCHEMES = (
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms",
    "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync",
    "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
    "itms-services",
)

# RFC 3986, appendix B, with the scheme grammar spelled out.
_PARTS = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?"
    r"(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
)

_BRACKET_HOST = r"^[^\[]*\[([^\]]*)"
_IPV6 = (
    r"(?i)^(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}"
    r"|(?=(?:[0-9a-f]{0,4}:){0,7}[0-9a-f]{0,4}$)"
    r"(?:(?:[0-9a-f]{1,4}:){1,7}|:)(?:(?::[0-9a-f]{1,4}){1,7}|:))$"
)
_IPV_FUTURE = r"^v[a-fA-F0-9]+\..+$"
_DOTTED_TAIL = (
    r"(?<=:)(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    r"(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}$"
)
# Characters that turn into one of / ? # @ : under NFKC.
_DELIMITER_LOOKALIKES = (
    r"[⁇-⁉℀℁℅℆⩴︓︖"
    r"﹕﹖﹟﹫＃／：？＠]"
)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def _scrub(url: Column) -> Column:
    return F.regexp_replace(url, r"[\t\r\n]|^[\x00-\x20]+", "")


def _decode(text: Column) -> Column:
    # A stray % stays as it is, so it is escaped before decoding.
    return F.try_url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(text: Column) -> Column:
    plus = F.url_encode(text)
    return F.replace(F.replace(plus, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _clean_query(query: Column) -> Column:
    """Drop tracking keys and keep, per key, the last value at the first position.

    Sorting by (key, position) keeps this n log n however many pairs a URL has.
    """
    pieces = F.filter(F.split(query, "&"), lambda x: x != "")
    pairs = F.transform(
        pieces,
        lambda x, i: F.struct(
            _decode(F.regexp_extract(x, "^[^=]*", 0)).alias("k"),
            i.alias("pos"),
            _decode(F.regexp_extract(x, "(?s)^[^=]*=(.*)", 1)).alias("v"),
        ),
    )

    def merge(s: Column) -> Column:
        firsts = F.filter(
            s, lambda x, i: (i == 0) | (F.get(s, i - 1)["k"] != x["k"])
        )
        lasts = F.filter(
            s, lambda x, i: F.coalesce(F.get(s, i + 1)["k"] != x["k"], F.lit(True))
        )
        return F.zip_with(
            firsts,
            lasts,
            lambda a, b: F.struct(a["pos"].alias("pos"), a["k"].alias("k"), b["v"].alias("v")),
        )

    merged = F.array_sort(let(F.array_sort(pairs), merge))
    wanted = F.filter(merged, lambda x: ~x["k"].isin(*TRACKING_KEYS))
    return F.array_join(
        F.transform(wanted, lambda x: F.concat(_encode(x["k"]), F.lit("="), _encode(x["v"]))),
        "&",
    )


def _authority_is_broken(authority: Column) -> Column:
    opened, closed = authority.contains("["), authority.contains("]")
    host = F.regexp_replace(
        F.regexp_extract(authority, _BRACKET_HOST, 1), _DOTTED_TAIL, "0:0"
    )
    bad_host = ~(host.rlike(_IPV6) | host.rlike(_IPV_FUTURE))
    return ((opened | closed) & ((opened != closed) | bad_host)) | authority.rlike(
        _DELIMITER_LOOKALIKES
    )


def _parts(url: Column) -> Column:
    return F.struct(
        F.lower(_part(url, 1)).alias("scheme"),
        F.lower(_part(url, 2)).alias("authority"),
        _part(url, 3).alias("path"),
        _part(url, 4).alias("query"),
    )


def _trimmed_path(path: Column, scheme: Column) -> Column:
    """Path without trailing slashes; ``;params`` of the last segment stay."""
    with_params = path.contains(";") & scheme.isin(*_PARAM_SCHEMES)
    base = F.regexp_extract(path, r"(?s)^(?:.*/)?[^/;]*", 0)
    params = F.regexp_extract(path, r"(?s)^(?:.*/)?[^/;]*(;[^/]+)\z", 1)
    slashes = r"/+\z"
    return F.when(
        with_params, F.concat(F.regexp_replace(base, slashes, ""), params)
    ).otherwise(F.regexp_replace(path, slashes, ""))


def _assembled(scheme: Column, authority: Column, path: Column) -> Column:
    rooted = F.when((path != "") & ~path.startswith("/"), F.lit("/")).otherwise("")
    slashes = path.startswith("//") | (
        scheme.isin(*_AUTHORITY_SCHEMES) & ((path == "") | path.startswith("/"))
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(authority != "", F.concat(F.lit("//"), authority, rooted))
        .when(slashes, "//")
        .otherwise(""),
        path,
    )


def normalized_url(url: Column) -> Column:
    """Normal form of a URL; NULL for a URL whose authority cannot be read."""

    def build(u: Column) -> Column:
        query = let(
            _clean_query(u["query"]),
            lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""),
        )
        address = let(
            _trimmed_path(u["path"], u["scheme"]),
            lambda p: _assembled(u["scheme"], u["authority"], p),
        )
        return F.when(
            ~_authority_is_broken(u["authority"]),
            F.concat(address, F.when(u["query"] == "", "").otherwise(query)),
        )

    return let(_parts(_scrub(url)), build)


def authority_of(url: Column) -> Column:
    return _part(url, 2)


def first_segment(url: Column) -> Column:
    """First path segment of an absolute URL, else empty."""
    return F.regexp_extract(url, r"^(?:[^:/?#]+:)?//[^/?#]*/([^/?#]+)", 1)


def host_name(url: Column) -> Column:
    """Authority without any ``www.``; empty for a relative URL."""
    return F.replace(authority_of(url), F.lit("www."), F.lit(""))


def first_label(url: Column) -> Column:
    """First dot-separated label of the host, capitalised."""
    label = F.split_part(
        F.replace(F.lower(authority_of(url)), F.lit("www."), F.lit("")), F.lit("."), F.lit(1)
    )
    return F.concat(F.upper(F.substring(label, 1, 1)), F.lower(F.substring(label, 2, 2147483647)))


def source_name(url: Column, policy: Column, value: Column) -> Column:
    return (
        F.when(policy == "constant", value)
        .when(policy == "host", host_name(url))
        .when(policy == "first_label", first_label(url))
    )


def with_normalized_url(df: DataFrame, col: str = "url", out: str = "norm_url") -> DataFrame:
    return df.withColumn(out, normalized_url(F.col(col)))


def with_source_name(
    df: DataFrame,
    url_col: str = "url",
    policy_col: str = "source_policy",
    value_col: str = "source_value",
    out: str = "source",
) -> DataFrame:
    return df.withColumn(out, source_name(F.col(url_col), F.col(policy_col), F.col(value_col)))
