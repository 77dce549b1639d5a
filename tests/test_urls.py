import urllib.parse as up

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom import with_normalized_url, with_source_name
from newsloom.functions.urls import TRACKING_KEYS

CASES = [
    ("HTTP://User@WWW.X.com:80/p//?b=1&a=2&b=3&utm_source=z#f", "http://user@www.x.com:80/p?b=3&a=2"),
    ("/news/x/?at_medium=rss", "/news/x"),
    ("#", ""),
    ("/", ""),
    ("http://x.com/?q=a b*~&e", "http://x.com?q=a+b%2A~&e="),
    ("http://x.com/p;v=1/?x=%zz", "http://x.com/p;v=1?x=%25zz"),
    ("http://x.com/a b|c", "http://x.com/a b|c"),
    ("http://x.com?ns_campaign=1", "http://x.com"),
    ("http://x.com/p?a=%2F+%C3%A9", "http://x.com/p?a=%2F+%C3%A9"),
    ("http://x.com/a/;p", "http://x.com/a;p"),
    ("//cdn.x.com/A/", "//cdn.x.com/A"),
    ("HTTPS://x.com/É/?é=1", "https://x.com/É?%C3%A9=1"),
    ("http://x.com/p?&&a=&=b", "http://x.com/p?a=&=b"),
    ("http://x.com/p?UTM_SOURCE=1", "http://x.com/p?UTM_SOURCE=1"),
    ("http://x.com/?a=%zz%41", "http://x.com?a=%25zzA"),
    ("http://[::1]:80/p/", "http://[::1]:80/p"),
    ("http://[::1/p", None),
    ("http://x]y/p", None),
    ("http://[word]/p", None),
    ("http://x℀y/p", None),
]


def normalized(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "i int, url string")
    return [r[0] for r in with_normalized_url(df).orderBy("i").select("norm_url").collect()]


def model(url):
    """The rule stated with Python's own URL functions."""
    try:
        p = up.urlparse(url)
    except ValueError:
        return None
    query = {}
    for key, value in up.parse_qsl(p.query, keep_blank_values=True):
        if key not in TRACKING_KEYS:
            query[key] = value
    return up.urlunparse(
        (p.scheme.lower(), p.netloc.lower(), p.path.rstrip("/"), p.params, up.urlencode(query), "")
    )


def test_cases(spark):
    assert normalized(spark, [u for u, _ in CASES]) == [n for _, n in CASES]


_piece = st.text("abAB019;/?#&=%+.~*-_ é|:@\t", max_size=14)
_url = st.builds(
    "{}{}{}{}".format,
    st.sampled_from(["", "http:", "HTTPS://", "//", "http://[", "mailto:", "x-y+z:", "ftp://h"]),
    st.sampled_from(["", "X.com", "user@Host:8", "a.b]", "É.org"]),
    st.sampled_from(["", "/", "//", "/p/q;r/", "/%41%zz/"]),
    _piece,
)


@settings(max_examples=8, deadline=None)
@given(st.lists(_url, min_size=40, max_size=120))
def test_equals_the_model(spark, urls):
    assert normalized(spark, urls) == [model(u) for u in urls]


def test_idempotent_on_ordinary_addresses(spark):
    urls = [f"HTTPS://Www.X.com/{p}/?{q}#t" for p in ("a", "a//", "b;c") for q in ("", "k=%20v&k=2&e")]
    once = normalized(spark, urls)
    assert normalized(spark, once) == once


def test_many_pairs_keep_first_position_and_last_value(spark):
    query = "&".join(f"k{i % 500}={i}" for i in range(5000))
    want = "http://x.com?" + "&".join(f"k{i}={4500 + i}" for i in range(500))
    assert normalized(spark, [f"http://x.com/?{query}"]) == [want]


def test_source_names(spark):
    rows = [
        ("https://www.x-y.com/a", "x-y.com", "X-y"),
        ("https://feeds.npr.org/1", "feeds.npr.org", "Feeds"),
        ("https://a.www.b.com/", "a.b.com", "A"),
        ("https://M.x.net:8080/", "M.x.net:8080", "M"),
        ("/relative", "", ""),
    ]
    df = spark.createDataFrame(rows, "url string, host string, label string").withColumn(
        "source_value", F.lit("Wire")
    )
    for policy, want in (("host", "host"), ("first_label", "label"), ("constant", "source_value")):
        named = with_source_name(df.withColumn("source_policy", F.lit(policy)))
        assert named.filter(~F.col("source").eqNullSafe(F.col(want))).count() == 0
