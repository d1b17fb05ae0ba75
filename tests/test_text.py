"""Column functions against the edge cases and against plain Python."""

import re
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tweetflow.functions import text as fn

ALPHABET = st.sampled_from(list("ab9_ @.\n-é中ßx") + ["@a", "@@", " @josé"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=60)
RELAXED = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression.alias("r")).collect()]


@pytest.mark.parametrize(
    "text, mentions, cleaned",
    [
        ("@a hello @b", ["@a", "@b"], " hello "),
        ("@a @a", ["@a", "@a"], " "),
        ("@a @a hi", ["@a", "@a"], "  hi"),
        ("nope", [], "nope"),
        ("a @ b", [], "a @ b"),
        ("write x@y.com", ["@y"], "write x.com"),
        ("hi @josé", ["@josé"], "hi "),
        ("@x\n", ["@x"], "\n"),
        ("", [], ""),
        (None, None, None),
    ],
)
def test_mentions_and_cleaning(spark, text, mentions, cleaned):
    assert column(spark, [text], fn.mentions("v")) == [mentions]
    assert column(spark, [text], fn.without_mentions("v")) == [cleaned]


def test_blank_is_about_spaces_only(spark):
    values = ["x", "  ", "", "\n", "\t", None]
    expected = [True, False, False, True, True, False]
    assert column(spark, values, fn.not_blank("v")) == expected
    assert column(spark, values, fn.null_or_empty("v")) == [False, False, True, False, False, True]


@given(TEXTS)
@RELAXED
def test_extraction_agrees_with_python(spark, texts):
    assert column(spark, texts, fn.mentions("v")) == [re.findall(r"@\w+", t) for t in texts]
    assert column(spark, texts, fn.without_mentions("v")) == [
        re.sub(r"@\w+", "", t) for t in texts
    ]


@given(TEXTS)
@RELAXED
def test_short_cuts_agree_with_the_long_way(spark, texts):
    short = column(spark, texts, fn.has_text_beyond_mentions("v"))
    assert short == column(spark, texts, fn.not_blank(fn.without_mentions("v")))
    found = column(spark, texts, F.size(fn.mentions("v")) > 0)
    assert column(spark, texts, fn.has_mention("v")) == found


APRIL_6 = datetime(2009, 4, 6, 22, 19, 45)


@pytest.mark.parametrize(
    "date, expected",
    [
        ("Mon Apr 06 22:19:45 PDT 2009", APRIL_6),
        ("Mon Apr 6 22:19:45 PDT 2009", APRIL_6),
        ("Mon Apr 06 22:19:45 UTC 2009", APRIL_6),
        ("Mon Apr 06 22:19:45 2009", APRIL_6),
        ("Tue Apr 06 22:19:45 PDT 2009", APRIL_6),
        ("Sat Feb 28 00:00:00 PST 2009", datetime(2009, 2, 28)),
        ("Mon Feb 30 22:19:45 PDT 2009", None),
        ("Foo Apr 06 22:19:45 PDT 2009", None),
        ("Apr 06 22:19:45 PDT 2009", None),
        ("2009-04-06", None),
        ("not a date", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, date, expected):
    assert column(spark, [date], fn.tweet_timestamp("v").cast("timestamp_ntz")) == [expected]


def test_usual_dates_are_cast_and_agree_with_the_parser(spark):
    dates = [
        f"{day} {month} {rest}"
        for day in ("Mon", "Sun")
        for month in ("Jan", "Feb", "Jun", "Dec")
        for rest in (
            "06 22:19:45 PDT 2009", "29 00:00:00 UTC 2008", "30 23:59:59 PDT 1000", "31 12:00:00 PST 9999",
            "00 12:00:00 PDT 2009", "32 12:00:00 PDT 2009", "01 24:00:00 PDT 2009", "01 29:00:00 PDT 2009",
        )
    ]
    unusual = ["Mon Jan 06 22:19:45 PDT 2009\n", "Mon Jan 06 22:19:45 PDTX 2009", "mon Jan 6 22:19:45 PDT 2009", ""]
    dates += [*unusual, None]
    digits = F.regexp_replace(F.regexp_replace("v", fn.ZONE_TOKEN, " "), fn.WEEKDAY, "")
    parsed = F.when(F.col("v").rlike(fn.WEEKDAY), F.try_to_timestamp(digits, F.lit(fn.DATE_FORMAT)))
    assert column(spark, dates, fn.tweet_timestamp("v")) == column(spark, dates, parsed)
    usual = column(spark, dates, F.col("v").rlike(fn.USUAL_DATE))
    assert usual == [True] * (len(dates) - 5) + [False] * 4 + [None]
