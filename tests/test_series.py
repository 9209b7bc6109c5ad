"""Snapshots, quarters, growth and series on hand-made observations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obslake.operators.lookup import lookup_join
from obslake.operators.quality import duplicate_keys, table_counts
from obslake.operators.series import (
    company_series, latest_observation, latest_top, quarterly_growth, quarterly_last,
    with_dimensions, with_periods,
)

FACTS = [  # observation, company, article, day, usd
    ("o1", "c1", "a1", dt.date(2022, 1, 5), 10), ("o2", "c1", "a2", dt.date(2022, 3, 31), 20),
    ("o3", "c1", "a3", dt.date(2022, 3, 31), 99), ("o4", "c1", "a4", dt.date(2022, 10, 1), 30),
    ("o5", "c2", "a5", dt.date(2023, 7, 1), 0), ("o6", "c2", "a6", dt.date(2023, 12, 1), 5),
    ("o7", "c3", "a7", dt.date(2020, 2, 2), 7),
]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(
        FACTS, "arr_observation_id string, company_id string, article_id string, "
        "observation_date date, arr_usd bigint")


@pytest.fixture(scope="module")
def companies(spark):
    return spark.createDataFrame(
        [("c1", "One"), ("c2", "Two"), ("c3", "Three")], "company_id string, company_name string")


def test_latest(facts):
    assert {r["arr_observation_id"] for r in latest_observation(facts).collect()} == {"o4", "o6", "o7"}
    plan = latest_observation(facts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert [r["company_id"] for r in latest_top(facts, 2).collect()] == ["c1", "c3"]


def test_quarters_and_growth(facts):
    quarters = quarterly_last(with_periods(facts))
    got = {tuple(r)[:3]: r["arr_usd"] for r in quarters.collect()}
    assert got == {("c1", 2022, 1): 20, ("c1", 2022, 4): 30, ("c2", 2023, 3): 0,
                   ("c2", 2023, 4): 5, ("c3", 2020, 1): 7}
    growth = {tuple(r)[:3]: (r["previous_arr_usd"], r["change_usd"], r["change_ratio"])
              for r in quarterly_growth(quarters).collect()}
    assert growth[("c1", 2022, 4)] == (20, 10, 0.5)
    assert growth[("c2", 2023, 4)] == (0, 5, None)
    assert growth[("c3", 2020, 1)] == (None, None, None)


def test_labels_from_the_article_agree_with_labels_from_the_date(facts, companies):
    articles = facts.select("article_id", F.year("observation_date").alias("published_year"),
                            F.quarter("observation_date").alias("published_quarter"))
    joined = quarterly_last(with_dimensions(facts, companies, articles))
    assert joined.exceptAll(quarterly_last(with_periods(facts))).count() == 0
    assert joined.count() == 5


def test_series_of_one_company(facts, companies):
    got = company_series(facts, companies, "One").collect()
    assert [r["arr_usd"] for r in got] == [10, 20, 99, 30]
    assert company_series(facts, companies, "Nobody").count() == 0


def test_counts_and_duplicates(facts):
    assert {tuple(r) for r in table_counts({"a": facts, "b": facts.where("arr_usd > 20")}).collect()} == {
        ("a", 7), ("b", 2)}
    assert {tuple(r) for r in duplicate_keys(facts, ["company_id"]).collect()} == {("c1", 4), ("c2", 2)}


def test_lookup_join_by_size(spark, facts, companies):
    small = lookup_join(facts, companies, "company_id")
    small.collect()  # in-memory tables have no known size before they are shuffled
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lookup_join(facts, companies, "company_id")
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert large.exceptAll(small).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_split_over_tasks(spark):
    """A third of all rows hold one key: the shuffled lookup splits them and loses none."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
            F.sha1(F.col("id").cast("string")).alias("v"))
        names = spark.range(300_000).select(F.col("id").alias("k"), F.lit("x").alias("n"))
        joined = lookup_join(rows, names, "k")
        result = joined.agg(F.sum(F.length("v")).alias("v"), F.count("n").alias("hits"))
        assert tuple(result.collect()[0]) == (300_000 * 40, 300_000)
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
