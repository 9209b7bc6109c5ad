"""Revenue text: expected values for every accepted notation and its edge cases."""

from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.functions.money import with_parsed_revenue

# Written text -> expected result.
VALID = {
    "$5,200,000,000": 5_200_000_000,
    "$790,000,000": 790_000_000,
    "$4,200,000,000": 4_200_000_000,
    "$45,000,000": 45_000_000,
    "$54,000,000,000": 54_000_000_000,
    "$980.0M": 980_000_000,
    "$16.800B": 16_800_000_000,
    "$170.0M": 170_000_000,
    "$1.030B": 1_030_000_000,
    "$12.600B": 12_600_000_000,
    "75000.0M USD": 75_000_000_000,
    "2300.0M USD": 2_300_000_000,
    "295.0M USD": 295_000_000,
    "500M USD": 500_000_000,
    "5.2B": 5_200_000_000,
    "$1.480 billion": 1_480_000_000,
    "$0.930 billion": 930_000_000,
    "$55.000 billion": 55_000_000_000,
    "$135.0 million": 135_000_000,
    "$7000.0 million": 7_000_000_000,
    "5.2 billion": 5_200_000_000,
    "$82000.0 million": 82_000_000_000,
    "€1,254,545,455": 1_380_000_000,
    "€36,818,181,818": 40_500_000_000,
    "€795,454,545": 875_000_000,
    "£244,094,488": 310_000_000,
    "£299,212,598": 379_999_999,
    "£114,173,228": 145_000_000,
    "¥360,000,000,000": 2_400_000_000,
    "¥2,400,000,000,000": 16_000_000_000,
    "¥255,000,000,000": 1_700_000_000,
}
RANGES = {
    "$38475.0M - $42525.0M": 40_500_000_000,
    "$57950.0M - $64050.0M": 61_000_000_000,
    "$1330.0M - $1470.0M": 1_400_000_000,
    "$10M - $20M": 15_000_000,
    "$10M to $20M": 15_000_000,
    "$10M–$20M": 15_000_000,
    "5 to 7 million": 3_500_002,
    "$10-20M": 10_000_005,
}
MISSING = [None, "", "   ", "N/A", "n/a", "Not disclosed", "UNDISCLOSED", "null", "-", "missing",
           "--", "none", "NaN", " na ", " N/A "]
UNPARSEABLE = ["garbage", "unknown format here", "$abc", "—", "99999999T", "to", "USD"]
EDGES = {  # text -> (amount, currency, is_range, status)
    "€10M - 20M": (15_500_000, "EUR", True, "valid_range"),
    "$1M - $2M - $3M": (1_000_000, "USD", False, "valid"),
    "-5M": (5_000_000, "USD", False, "valid"),
    "5k": (5_000, "USD", False, "valid"),
    "5.2Bn": (5, "USD", False, "valid"),
    "500MUSD": (500, "USD", False, "valid"),
    "1.254.540 EUR": (1_379_994, "EUR", False, "valid"),
    "$5M EUR": (5_000_000, "USD", False, "valid"),
    "EUR 5M": (5_500_000, "EUR", False, "valid"),
    "eur 5m": (5_500_000, "EUR", False, "valid"),
    "¥150": (1, "JPY", False, "valid"),
    "2.5": (2, "USD", False, "valid"),
    "3.5": (4, "USD", False, "valid"),
    "5 million K": (5_000, "USD", False, "valid"),
    "5K million": (5_000, "USD", False, "valid"),
    "M 5M": (5_000_000, "USD", False, "valid"),
    "1M2 5M": (12_000_000, "USD", False, "valid"),
    "1, to 2": (2, "USD", True, "valid_range"),
    "10 - n/a": (10, "USD", False, "valid"),
    " $5M ": (5_000_000, "USD", False, "valid"),
}


def parse(spark, texts):
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "i int, t string")
    parsed = with_parsed_revenue(frame, "t").select("i", "revenue_parsed.*").collect()
    return [r for r in sorted(parsed, key=lambda r: r["i"])]


def test_known_texts(spark):
    for table, status, ranged in ((VALID, "valid", False), (RANGES, "valid_range", True)):
        got = parse(spark, list(table))
        assert {t: r["arr_usd"] for t, r in zip(table, got)} == table
        assert {r["parse_status"] for r in got} == {status}
        assert {r["is_range"] for r in got} == {ranged}


def test_missing_and_unparseable(spark):
    for texts, status in ((MISSING, "invalid_missing"), (UNPARSEABLE, "unparseable")):
        got = parse(spark, texts)
        assert {t: r["parse_status"] for t, r in zip(texts, got)} == dict.fromkeys(texts, status)
        assert all(r["arr_usd"] is None and r["currency_original"] is None for r in got)
        assert all(r["is_range"] is False for r in got)


def test_edges(spark):
    got = parse(spark, list(EDGES))
    fields = ("arr_usd", "currency_original", "is_range", "parse_status")
    assert {t: tuple(r[f] for f in fields) for t, r in zip(EDGES, got)} == EDGES


def test_raw_value_is_the_stripped_text(spark):
    assert [r["raw_value"] for r in parse(spark, [" $5M ", None])] == ["$5M", None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 10**13), min_size=1, max_size=40))
def test_formatting_then_parsing_gives_the_number_back(spark, numbers):
    styles = [lambda n: f"${n:,}", lambda n: f"{n // 1000}.{n % 1000:03d}K",
              lambda n: f"$ {n // 10**6}.{n % 10**6:06d} million", lambda n: f"{n} USD"]
    for style in styles:
        assert [r["arr_usd"] for r in parse(spark, [style(n) for n in numbers])] == numbers


def test_filter_on_the_result_does_not_repeat_the_parse(spark):
    frame = with_parsed_revenue(spark.createDataFrame([("$5M",)], "t string"), "t")
    kept = frame.where("revenue_parsed.arr_usd > 1").select("t")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("thousand|million") <= 4  # extract and replace, for two amounts
    assert kept.count() == 1
