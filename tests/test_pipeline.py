"""The whole build on files with known contents."""

import csv
import glob
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from obslake.operators.quality import duplicate_keys
from obslake.operators.search import find_similar_articles, hybrid_search_articles
from obslake.operators.series import lineage
from obslake.plans.export import ai_articles_enriched
from obslake.plans.job import main, run_job, run_pipeline
from obslake.rules import CATEGORY_GROUPS
from obslake.schemas import (
    AI_EXPORT_COLUMNS, BRONZE_COMPANIES, DIM_ARTICLE, DIM_COMPANY, FACT_ARR_OBSERVATION,
    PARSE_ERRORS, SILVER_ARTICLES, UNMATCHED_COMPANIES,
)
from obslake.sources.tables import read_embeddings, read_table, register_views
from tests.companies import COMPANIES
from tests.news import COLUMNS, UNMATCHED, truth, write_articles, write_companies


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    write_articles(folder / "news.csv", [r["cells"] for r in truth()])
    write_companies(folder / "companies.json")
    return str(folder / "news.csv"), str(folder / "companies.json")


@pytest.fixture(scope="module")
def tables(spark, files):
    return run_pipeline(spark, *files)


def test_row_counts(tables):
    counts = {name: df.count() for name, df in tables.by_name().items()}
    assert counts == {
        "bronze_articles": 750, "bronze_companies": 21, "silver_articles": 750, "dim_company": 21,
        "dim_article": 750, "fact_arr_observation": 538, "unmatched_companies": 5,
        "parse_errors": 192}


def test_schemas(tables):
    expected = {
        "bronze_companies": BRONZE_COMPANIES, "silver_articles": SILVER_ARTICLES,
        "dim_company": DIM_COMPANY, "dim_article": DIM_ARTICLE,
        "fact_arr_observation": FACT_ARR_OBSERVATION, "parse_errors": PARSE_ERRORS,
        "unmatched_companies": UNMATCHED_COMPANIES}
    for name, schema in expected.items():
        got = getattr(tables, name).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema], name
    assert tables.bronze_articles.columns == [*COLUMNS, "source_file", "source_hash", "ingested_at"]


def test_silver_recovers_the_truth(tables):
    got = {r["source_article_id"]: r for r in tables.silver_articles.collect()}
    for row in truth():
        cells, silver = row["cells"], got[row["cells"]["article_id"]]
        assert silver["published_date"] == row["day"], cells
        assert silver["arr_usd"] == row["amount"], cells
        assert silver["company_name_resolved"] == row["company"], cells
        assert silver["company_name_raw"] == cells["company_name"].strip()
        assert silver["title"] == cells["title"] and silver["word_count"] == cells["word_count"]
        assert silver["category_standardized"] == CATEGORY_GROUPS.get(cells["category"], "UNKNOWN")
        assert silver["author"] == ("" if cells["author"] == "NA" else cells["author"])
        assert silver["revenue_raw"] == ("" if cells["revenue"] == "N/A" else cells["revenue"])


def test_bronze_provenance(tables, files):
    digest = hashlib.sha1(open(files[0], "rb").read()).hexdigest()
    rows = tables.bronze_articles.select("source_file", "source_hash").distinct().collect()
    assert [r["source_hash"] for r in rows] == [digest]
    assert rows[0]["source_file"].endswith("/news.csv")
    assert tables.bronze_companies.where("source_hash is null or ingested_at is null").count() == 0


def test_dim_company(tables):
    got = {r["company_name"]: r for r in tables.dim_company.collect()}
    for name, year, place, employees, industry, public, ticker in COMPANIES:
        r = got[name]
        assert (r["founded_year"], r["headquarters"], r["employee_count"], r["industry"],
                r["is_public"], r["stock_ticker"]) == (
                    year, place, employees, industry, public, ticker)
    assert got["OpenAI"]["company_id"] == "COMP-A19EE5A9FDC19109"
    assert got["Scale AI"]["company_id"] == "COMP-3DA36D688D43678F"


def test_keys_are_unique_and_stable(tables):
    assert duplicate_keys(tables.dim_article, ["article_id"]).count() == 0
    grain = ["company_id", "article_id", "observation_date"]
    assert duplicate_keys(tables.fact_arr_observation, grain).count() == 0
    first = tables.silver_articles.where("source_article_id = 'ART0001'").first()
    assert first["article_id"] == "ART-77B8C33CF8A99CF7"
    fact = tables.fact_arr_observation.first()
    text = f"{fact['company_id']}|{fact['article_id']}|{fact['observation_date']}"
    digest = hashlib.sha1(text.encode()).hexdigest()[:24].upper()
    assert fact["arr_observation_id"] == f"ARR-{digest}"


def test_unmatched_and_errors(tables):
    assert {r[0]: r[1] for r in tables.unmatched_companies.collect()} == UNMATCHED
    assert tables.unmatched_companies.first()[0] == "Cohere"
    errors = tables.parse_errors.collect()
    assert {r["field"] for r in errors} == {"revenue"}
    assert {r["issue"] for r in errors} == {"invalid_missing"}
    assert sum(r["company_name"] in UNMATCHED for r in errors) == 5
    assert tables.dim_article.where("arr_usd is null").count() == 192


def test_enrichment(tables):
    rows = tables.dim_article.select(
        "company_name_resolved", "employee_count", "company_size_category", "company_age",
        "founded_year", "published_year").collect()
    for r in rows:
        if r["company_name_resolved"] is None:
            # an unknown head count has no band
            assert r["company_size_category"] is None and r["company_age"] is None
        else:
            n = r["employee_count"]
            band = "Small" if n < 10_000 else "Medium" if n <= 30_000 else "Large"
            assert r["company_size_category"] == band
            assert r["company_age"] == r["published_year"] - r["founded_year"]


def test_every_article_is_accounted_for(tables):
    errors = tables.parse_errors.select("article_id").distinct()
    facts = tables.fact_arr_observation.select("article_id")
    rest = tables.silver_articles.join(errors, "article_id", "left_anti").join(
        facts, "article_id", "left_anti")
    assert rest.where("company_id is not null").count() == 0
    assert errors.join(facts, "article_id").count() == 0


def test_rebuild_gives_the_same_rows(spark, files, tables):
    again = run_pipeline(spark, *files)
    for name in ("dim_article", "fact_arr_observation", "parse_errors"):
        a, b = getattr(tables, name), getattr(again, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lineage(tables):
    rows = lineage(tables.fact_arr_observation, tables.dim_article, tables.bronze_articles)
    assert rows.count() == 538
    assert rows.where("source_revenue <> revenue_raw or source_hash is null").count() == 0


def expected_export():
    industries = {c[0]: c[4] for c in COMPANIES}
    ids = set()
    for r in truth():
        ai = (CATEGORY_GROUPS.get(r["cells"]["category"]) == "AI_ML"
              or industries.get(r["company"]) == "AI/ML")
        if ai and 2022 <= r["day"].year <= 2024 and (r["amount"] or 0) > 50_000_000:
            ids.add("ART-" + hashlib.sha1(r["cells"]["article_id"].encode()).hexdigest()[:16].upper())
    return ids


def test_export_filter(tables):
    export = ai_articles_enriched(tables.dim_article)
    assert export.columns == list(AI_EXPORT_COLUMNS)
    rows = export.collect()
    assert {r["article_id"] for r in rows} == expected_export() and len(rows) > 20
    assert all(r["embedding"] is None for r in rows)


def test_export_boundaries(spark, tables):
    base = tables.dim_article.where("company_id is not null").limit(1).withColumns({
        "category_standardized": F.lit("AI_ML"), "industry": F.lit(None).cast("string")})
    kept = {}
    for year, usd in ((2021, 10**9), (2022, 50_000_001), (2024, 10**9), (2025, 10**9),
                      (2023, 50_000_000), (2023, None)):
        row = base.withColumns({
            "published_year": F.lit(year), "arr_usd": F.lit(usd).cast("bigint")})
        kept[year, usd] = ai_articles_enriched(row).count()
    assert kept == {(2021, 10**9): 0, (2022, 50_000_001): 1, (2024, 10**9): 1, (2025, 10**9): 0,
                    (2023, 50_000_000): 0, (2023, None): 0}


def test_export_with_vectors(tables):
    vectors = tables.silver_articles.select(
        "article_id", F.array_repeat(F.lit(0.0).cast("float"), 384).alias("embedding"))
    similar = tables.silver_articles.select(
        "article_id", F.array(F.lit("A"), F.lit("B"), F.lit("C")).alias("top_similar_articles"))
    rows = ai_articles_enriched(tables.dim_article, vectors, similar).collect()
    assert {len(r["embedding"]) for r in rows} == {384}
    assert {tuple(r["top_similar_articles"]) for r in rows} == {("A", "B", "C")}


def test_export_fails_on_a_missing_vector(tables):
    some = tables.silver_articles.select(
        "article_id", F.array(F.lit(0.0).cast("float")).alias("embedding")).limit(3)
    with pytest.raises(Exception, match="no embedding for article"):
        ai_articles_enriched(tables.dim_article, some).collect()


def test_job_writes_every_table(spark, files, tmp_path):
    out = str(tmp_path)
    for _ in range(2):  # the second run replaces the first
        counts = {r[0]: r[1] for r in run_job(spark, *files, out).collect()}
    assert counts["fact_arr_observation"] == 538 and counts["dim_article"] == 750
    articles = read_table(spark, out, "dim_article")
    assert articles.count() == 750
    assert articles.where(F.size("embedding") == 384).count() == 750
    assert articles.where("published_year = 2021").inputFiles()
    assert glob.glob(f"{out}/dim_article/published_year=2021")
    title = truth()[40]["cells"]["title"]
    vectors = read_embeddings(spark, out)
    assert vectors.count() == 750
    assert find_similar_articles(vectors, "about nobody part 300", 3).count() == 3
    recent = hybrid_search_articles(articles, title, 4, published_year_from=2021)
    assert recent.where("published_year < 2021").count() == 0 and recent.count() == 4
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(published_year" in plan and "(published_year" in plan
    assert "summary" not in plan.split("ReadSchema")[1]  # unused columns are not read
    register_views(spark, out)
    top = spark.sql("""
        SELECT observation_date, arr_usd FROM fact_arr_observation
        WHERE company_id = (SELECT company_id FROM dim_company WHERE company_name = 'Snowflake')
        ORDER BY observation_date""").collect()
    snowflake = [r for r in truth() if r["company"] == "Snowflake" and r["amount"]]
    assert [tuple(r) for r in top] == sorted((r["day"], r["amount"]) for r in snowflake)

    lines = []
    for part in glob.glob(f"{out}/csv/ai_articles_enriched/*.csv"):
        with open(part, newline="", encoding="utf-8") as f:
            lines += list(csv.DictReader(f))
    assert {r["article_id"] for r in lines} == expected_export()
    assert all(len(json.loads(r["embedding"])) == 384 for r in lines)
    assert all(len(json.loads(r["top_similar_articles"])) == 3 for r in lines)
    assert {r["title"] for r in lines} <= {r["cells"]["title"] for r in truth()}


def test_job_without_vectors_and_tables(spark, files, tmp_path):
    out = str(tmp_path)
    main(["--articles", files[0], "--companies", files[1], "--out", out, "--no-embeddings",
          "--no-tables"])
    assert {p.split("/")[-1] for p in glob.glob(f"{out}/*")} == {"csv", "layers"}
    layers = {p.split("/")[-1] for p in glob.glob(f"{out}/layers/*")}
    assert layers == {"bronze_articles", "bronze_companies", "cleaned_articles"}
    assert len(glob.glob(f"{out}/csv/*")) == 9
