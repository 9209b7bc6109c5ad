"""New files, changed articles, replays and compaction."""

import pytest

from obslake.functions.dates import with_parsed_date
from obslake.functions.money import with_parsed_revenue
from obslake.plans.gold import fact_arr_observation
from obslake.plans.silver import clean_articles
from obslake.schemas import RAW_ARTICLES
from obslake.sources.files import csv_options, read_articles, read_companies
from obslake.streaming import incremental
from obslake.streaming.incremental import append_batch, compact, current_articles, start_ingest
from tests.news import truth, write_articles, write_companies


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()
    write_companies(tmp_path / "companies.json")
    return tmp_path


def run(spark, place, companies):
    start_ingest(spark, str(place / "in"), companies, str(place / "out")).awaitTermination()


def state(spark, place):
    rows = current_articles(spark, str(place / "out")).collect()
    assert len({r["article_id"] for r in rows}) == len(rows)
    return {r["source_article_id"]: (r["arr_usd"], r["published_date"], r["company_name_resolved"])
            for r in rows}


def expected(cells, overrides=()):
    changed = dict(overrides)
    return {r["cells"]["article_id"]: (
        changed.get(r["cells"]["article_id"], r["amount"]), r["day"], r["company"]) for r in cells}


def test_ingest_update_replay_and_compaction(spark, place):
    rows = truth()[180:240]
    cells = [r["cells"] for r in rows]
    companies = read_companies(spark, str(place / "companies.json"))
    write_articles(place / "in" / "one.csv", cells[:40])
    run(spark, place, companies)
    assert state(spark, place) == expected(rows[:40])

    # the second file adds twenty articles and corrects one of the first
    corrected = {**cells[3], "revenue": "$77,000,000"}
    write_articles(place / "in" / "two.csv", [*cells[40:], corrected])
    run(spark, place, companies)
    target = expected(rows, {cells[3]["article_id"]: 77_000_000})
    assert state(spark, place) == target

    run(spark, place, companies)  # nothing new
    assert state(spark, place) == target

    assert compact(spark, str(place / "out")) == 1
    assert state(spark, place) == target
    assert compact(spark, str(place / "out")) == 1

    again = {**cells[5], "revenue": "$88,000,000"}
    write_articles(place / "in" / "three.csv", [again])
    run(spark, place, companies)
    target = expected(rows, {cells[3]["article_id"]: 77_000_000, cells[5]["article_id"]: 88_000_000})
    assert state(spark, place) == target
    assert compact(spark, str(place / "out")) == 2
    assert state(spark, place) == target

    # incremental and full build agree
    whole = clean_articles(read_articles(spark, str(place / "in" / "two.csv")), companies)
    current = current_articles(spark, str(place / "out")).select(*whole.columns)
    assert whole.exceptAll(current).count() == 0
    assert fact_arr_observation(current).count() > 0


def test_replayed_batch_overwrites_itself(spark, place):
    cells = [r["cells"] for r in truth()[30:40]]
    companies = read_companies(spark, str(place / "companies.json"))
    write_articles(place / "in" / "one.csv", [*cells, {**cells[0], "revenue": "zzz"}])
    batch = read_articles(spark, str(place / "in")).withColumnRenamed("ingested_at", "file_time")
    append_batch(batch, 0, companies, str(place / "out"))
    first = state(spark, place)
    append_batch(batch, 0, companies, str(place / "out"))
    assert state(spark, place) == first and len(first) == 10


def test_empty_start(spark, place):
    assert current_articles(spark, str(place / "out")).count() == 0
    assert compact(spark, str(place / "out")) == -1


def test_parsers_run_on_a_stream(spark, place):
    cells = [r["cells"] for r in truth()[300:320]]
    write_articles(place / "in" / "one.csv", cells)
    stream = spark.readStream.schema(RAW_ARTICLES).options(**csv_options(True)).csv(str(place / "in"))
    parsed = with_parsed_date(with_parsed_revenue(stream, "revenue", "m"), "published_date", "d")
    query = (
        parsed.select("article_id", "m.arr_usd", "d.date").where("arr_usd is not null")
        .writeStream.format("memory").queryName("parsed_stream").trigger(availableNow=True).start())
    query.awaitTermination()
    got = {r["article_id"]: (r["arr_usd"], r["date"]) for r in spark.table("parsed_stream").collect()}
    assert got == {r["cells"]["article_id"]: (r["amount"], r["day"]) for r in truth()[300:320]}


def test_rows_of_a_file_are_dealt_out_before_they_are_sorted(spark, place, monkeypatch):
    """One file is one task of the reader: no sort may stand between it and the first shuffle."""
    cells = [r["cells"] for r in truth()[30:50]]
    companies = read_companies(spark, str(place / "companies.json"))
    write_articles(place / "in" / "one.csv", [*cells, {**cells[0], "revenue": "zzz"}, cells[1]])
    batch = read_articles(spark, str(place / "in")).withColumnRenamed("ingested_at", "file_time")
    plans, write = [], incremental.materialise

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(incremental, "materialise", watched)
    append_batch(batch, 0, companies, str(place / "out"))
    lines = plans[0].splitlines()  # the last steps come first
    dealt = next(i for i, line in enumerate(lines) if "REBALANCE" in line)
    assert not any("Sort [article_id" in line or "WindowGroupLimit" in line for line in lines[dealt:])
    assert len(state(spark, place)) == 20
