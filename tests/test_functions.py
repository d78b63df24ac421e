import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from devsignals import params
from devsignals.functions import numeric, text, times
from devsignals.operators import stories


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**6, 10**6), st.integers(0, 5000)), min_size=1, max_size=200))
def test_ratios_equal_decimal_rounding(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = df.select("a", "b", numeric.ratio(F.col("a"), F.col("b")).alias("r"),
                    numeric.percent(F.col("a"), F.col("b"), 1).alias("p")).collect()
    for row in got:
        if row.b == 0:
            assert row.r is None and row.p is None
            continue
        exact = Decimal(row.a) / Decimal(row.b)
        assert row.r == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert row.p == float((exact * 100).quantize(Decimal("0.1"), ROUND_HALF_UP))


@pytest.mark.parametrize("url, domain", [
    ("https://a.b/c", "a.b"), ("http://a.b?x=1", "a.b?x=1"), ("https://a.b#top", "a.b#top"), ("ftp://a.b/c", "ftp:"),
    ("https://a.b/c\nd", "a.b"), ("https://www.a.b:8080/", "www.a.b:8080"), ("", None), (None, None),
])
def test_url_domain(spark, url, domain):
    url = F.lit(url).cast("string")
    assert one(spark, text.url_domain(url)) == domain
    assert one(spark, text.has_text(url)) is (domain is not None)


REACT, CODE, NEXT = (name for name, _, _ in params.MENTION_PATTERNS)


@pytest.mark.parametrize("title, found", [
    ("React vs Next.js", {REACT, NEXT}), ("reactive programming", set()), ("(reactjs)", {REACT}), ("react.js!", {REACT}),
    ("use-react.", {REACT}), ("preact", set()), ("VS Code", {CODE}), ("vs  code", {CODE}), ("Visual Studio Code 2", {CODE}),
    ("vscodeext", set()), ("next js", {NEXT}), ("Next.JS", {NEXT}), ("about\nreact\n", {REACT}), ("", set()),
    ("react react", {REACT}), ("vscode and nextjs for react", {REACT, CODE, NEXT}),
])
def test_mentions(spark, title, found):
    df = spark.createDataFrame([(1, title, None, None, 1, 0, None, None, None)],
                               "story_id int, title string, author string, url string, score int, comment_count int, "
                               "published_at timestamp_ntz, activity_date date, fetched_at timestamp_ntz")
    assert sorted(r.mentioned_repo for r in stories.mentions(df).collect()) == sorted(found)


def test_needles_change_nothing(spark, data):
    titles = spark.read.parquet(f"{data}/documents.parquet").select(F.concat(F.lit("React or VS  Code, next js? "), "text").alias("t"))
    titles = titles.unionByName(spark.read.parquet(f"{data}/pages.parquet").select(F.col("html").alias("t")))
    bare = [(name, pattern, None) for name, pattern, _ in params.MENTION_PATTERNS]
    flags = text.mentions_any(F.col("t"), bare) == text.mentions_any(F.col("t"), params.MENTION_PATTERNS)
    assert titles.filter(~F.coalesce(flags, F.lit(True))).count() == 0
    plain = F.array_compact(text.mentioned_names(F.col("t"), bare))
    quick = F.array_compact(text.mentioned_names(F.col("t"), params.MENTION_PATTERNS))
    assert titles.filter(plain != quick).count() == 0


def test_mentions_need_a_pattern(spark):
    with pytest.raises(ValueError):
        stories.mentions(spark.range(1), ())


def test_surrogate_key_of_null_is_null(spark):
    assert one(spark, text.surrogate_key(F.lit(None), "s")) is None


@pytest.mark.parametrize("seconds, expected", [(4680, "1h 18m"), (1080, "18m"), (59, "0m"), (-10, "0m"), (90000, "25h 0m")])
def test_duration_text(spark, seconds, expected):
    now = dt.datetime(2024, 1, 10)
    start = times.moment(now - dt.timedelta(seconds=seconds))
    assert one(spark, times.duration_text(start, times.moment(now))) == expected


def test_duration_of_nothing(spark):
    none = F.lit(None).cast("timestamp_ntz")
    assert one(spark, times.duration_text(none, times.moment(dt.datetime(2024, 1, 1)))) == "Unknown"


@pytest.mark.parametrize("hours, label", [(24.0, "fresh"), (24.1, "stale"), (48.0, "stale"), (48.1, "error"), (None, "unknown")])
def test_freshness_label(spark, hours, label):
    assert one(spark, times.freshness_label(F.lit(hours).cast("double"))) == label


def test_epoch_seconds_do_not_depend_on_the_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, times.from_epoch_seconds(F.lit(1704067200))) == dt.datetime(2024, 1, 1)
        gap = times.micros_between(times.moment(dt.datetime(2024, 3, 10)), times.moment(dt.datetime(2024, 3, 11, 0, 0, 0, 5)))
        assert one(spark, gap) == 86400 * 10**6 + 5
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_windows_and_weeks(spark):
    assert times.date_window(dt.date(2024, 1, 31)) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    with pytest.raises(ValueError):
        times.checked_range(dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    assert one(spark, times.week_start(F.lit(dt.date(2024, 1, 7)))) == dt.date(2024, 1, 1)


def test_labels(spark):
    assert one(spark, text.account_class(F.lit("dependabot[bot]"))) == "Bot"
    assert one(spark, text.account_class(F.lit("ann"))) == "User"
    assert one(spark, text.thousands(F.lit(1234567))) == "1,234,567"
    assert one(spark, text.relabel(F.lit("x"), {"y": "z"})) == "x"
    names = {"vercel/next.js": True, "a/b/c": False, "ab": False, "a/b\n": False}
    assert {n: one(spark, text.is_repository_name(F.lit(n))) for n in names} == names
