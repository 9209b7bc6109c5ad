"""Date text: expected values for every accepted notation and its edge cases."""

import datetime as dt
from dataclasses import replace

from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.functions.dates import with_parsed_date
from obslake.rules import DEFAULT_RULES

# Written text -> expected result.
VALID = {
    "2022-02-17": "2022-02-17",
    "2023-12-13": "2023-12-13",
    "2021-09-11T00:00:00Z": "2021-09-11",
    "02/23/2023": "2023-02-23",
    "12/28/2021": "2021-12-28",
    "04/30/2020": "2020-04-30",
    "13/05/2023": "2023-05-13",
    "23-08-2023": "2023-08-23",
    "06-21-2024": "2024-06-21",
    "10-28-2024": "2024-10-28",
    "05-15-2023": "2023-05-15",
    "October 19, 2022": "2022-10-19",
    "February 25, 2020": "2020-02-25",
    "September 07, 2021": "2021-09-07",
    "21 Feb 2020": "2020-02-21",
    "27 Sep 2020": "2020-09-27",
    "10/05/2023": "2023-05-10",
    "05/10/2023": "2023-05-10",
    "10-05-2023": "2023-05-10",
    "07/07/2023": "2023-07-07",
    "2022-02-17junk": "2022-02-17",
    "Oct 19 2022": "2022-10-19",
    "Oct 192022": "2022-10-19",
    "Janvier 5, 2021": "2021-01-05",
    "21 September 2020": "2020-09-21",
    "Sept 3, 2020": "2020-09-03",
    " 2022-02-17 ": "2022-02-17",
    "2/3/2021": "2021-02-03",
    "29-02-2024": "2024-02-29",
}
INVALID = ["not a date", "garbage", "0000-99-99", "13/13/2023", "02/30/2023", "Foo 5, 2021",
           "2022/02/17", "2/3/21", "0000-01-01", "00/05/2023", "29-02-2023", "02/23-2023",
           "Oct 45, 2022", "2022-2-17"]
MISSING = [None, "", "   "]


def parse(spark, texts, rules=DEFAULT_RULES):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    parsed = with_parsed_date(frame, "t", rules=rules).select("i", "date_parsed.*").collect()
    return sorted(parsed, key=lambda r: r["i"])


def test_known_texts(spark):
    got = parse(spark, list(VALID))
    assert {t: str(r["date"]) for t, r in zip(VALID, got)} == VALID
    assert {r["parse_status"] for r in got} == {"valid"}
    assert all((r["year"], r["month"]) == (r["date"].year, r["date"].month) for r in got)


def test_parts(spark):
    got = parse(spark, ["2023-12-13", "2022-03-01"])
    assert [(r["year"], r["quarter"], r["month"]) for r in got] == [(2023, 4, 12), (2022, 1, 3)]


def test_no_date(spark):
    for texts, status in ((INVALID, "invalid"), (MISSING, "invalid_missing")):
        got = parse(spark, texts)
        assert {t: r["parse_status"] for t, r in zip(texts, got)} == dict.fromkeys(texts, status)
        assert all(r["date"] is None and r["year"] is None and r["note"] for r in got)


def test_month_first_option(spark):
    rules = replace(DEFAULT_RULES, ambiguous_dates="month_first")
    texts = ["10/05/2023", "05/10/2023", "13-05-2023", "06-21-2024"]
    assert [str(r["date"]) for r in parse(spark, texts, rules)] == [
        "2023-10-05", "2023-05-10", "2023-05-13", "2024-06-21"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1000, 1, 1)), min_size=1, max_size=40))
def test_formatting_then_parsing_gives_the_date_back(spark, days):
    for style in ("%Y-%m-%d", "%B %d, %Y", "%d %b %Y", "%b %d %Y"):
        assert [r["date"] for r in parse(spark, [d.strftime(style) for d in days])] == days
