"""Every operator as a query over the given tables, one function per query."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.category import is_ai_category, standardize_category
from obslake.functions.dates import with_parsed_date
from obslake.functions.keys import article_key, company_key, observation_key
from obslake.functions.money import with_parsed_revenue
from obslake.functions.vectors import from_json, to_json
from obslake.operators import series
from obslake.operators.encode import article_text, encode_text
from obslake.operators.neighbours import top_neighbours
from obslake.operators.quality import duplicate_keys, table_counts
from obslake.operators.resolve import with_company
from obslake.operators.search import find_similar, hybrid_search
from obslake.plans import gold, silver
from obslake.plans.export import ai_articles_enriched
from obslake.queries.inputs import (
    date_text, messy_orders, nation_companies, revenue_text, table, tens, whole_price, with_commas,
    with_point,
)
from obslake.rules import DEFAULT_RULES
from obslake.session import materialise, spread, work_folder
from obslake.sinks.tables import write_csv, write_embeddings, write_table
from obslake.sources.files import file_hashes, read_companies, scan_articles
from obslake.sources.tables import read_embeddings, read_table
from obslake.streaming.incremental import compact, current_articles, start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
EXPORT_RULES = replace(DEFAULT_RULES, ai_year_from=1995, ai_year_to=1998, ai_arr_above=200_000)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- revenue text -------------------------------------------------------------------------------

def _revenue(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")).select(
        "o_orderkey", text.alias("revenue"))
    parsed = with_parsed_revenue(orders, "revenue", "p")
    return parsed.select(
        "o_orderkey", F.col("p.arr_usd").alias("arr_usd"),
        F.col("p.currency_original").alias("currency"), F.col("p.is_range").alias("is_range"),
        F.col("p.parse_status").alias("status"))


@query
def revenue_suffix(spark, sf_dir):
    return _revenue(spark, sf_dir, F.concat(with_point(whole_price(), 3), F.lit("K")))


@query
def revenue_symbol_commas(spark, sf_dir):
    return _revenue(spark, sf_dir, F.concat(F.lit("$"), with_commas(whole_price())))


@query
def revenue_word_scale(spark, sf_dir):
    text = F.concat(F.lit("$"), with_point(whole_price(), 6), F.lit(" million"))
    return _revenue(spark, sf_dir, text)


@query
def revenue_fx(spark, sf_dir):
    symbol = F.element_at(F.array(*[F.lit(s) for s in "€£¥"]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return _revenue(spark, sf_dir, F.concat(symbol, with_commas(whole_price())))


@query
def revenue_range_midpoint(spark, sf_dir):
    low = whole_price()
    high = low + 2000 + F.col("o_orderkey") % 2
    return _revenue(spark, sf_dir, F.concat(
        F.lit("$"), low.cast("string"), F.lit(" to $"), high.cast("string")))


@query
def revenue_missing_status(spark, sf_dir):
    return _revenue(spark, sf_dir, revenue_text(whole_price(), F.col("o_orderkey")))


@query
def revenue_lineitem(spark, sf_dir):
    """The parser at volume: one text per line item, three notations."""
    n = F.floor("l_extendedprice").cast("bigint")
    text = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("$"), with_commas(n))).when(
        F.col("l_linenumber") % 3 == 1, F.concat(with_point(n, 3), F.lit("K USD"))).otherwise(
        F.concat(n.cast("string"), F.lit(" - "), (n + 10).cast("string")))
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", "l_extendedprice")
    rows = spread(lines).select("l_suppkey", text.alias("revenue"))
    parsed = with_parsed_revenue(rows, "revenue", "p")
    return parsed.groupBy("l_suppkey").agg(
        F.sum("p.arr_usd").alias("arr_usd"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("p.is_range").cast("bigint")).alias("ranges"))


# --- date text ----------------------------------------------------------------------------------

def _dates(spark: SparkSession, sf_dir: str, text: Column) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("written"))
    return with_parsed_date(orders, "written", "p")


@query
def date_formats(spark, sf_dir):
    parsed = _dates(spark, sf_dir, date_text(F.col("o_orderdate").cast("date"), F.col("o_orderkey")))
    return parsed.select("o_orderkey", F.col("p.date").alias("parsed_date"),
                         F.col("p.parse_status").alias("status"))


@query
def date_ambiguous(spark, sf_dir):
    pattern = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
    text = pattern.otherwise(F.date_format("o_orderdate", "M-d-yyyy"))
    return _dates(spark, sf_dir, text).select("o_orderkey", F.col("p.date").alias("parsed_date"))


@query
def date_parts(spark, sf_dir):
    parsed = _dates(spark, sf_dir, F.date_format("o_orderdate", "MMM d yyyy"))
    return parsed.select("o_orderkey", *[
        F.col(f"p.{part}").cast("bigint").alias(part) for part in ("year", "quarter", "month")])


# --- categories and keys ------------------------------------------------------------------------

@query
def category_taxonomy(spark, sf_dir):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "view", "AI & ML").when(kind == "click", " Big Data ")
        .when(kind == "purchase", "Finance").when(kind == "signup", "cloud"))
    group = standardize_category(raw)
    return table(spark, sf_dir, "events").select(
        "event_id", group.alias("category_standardized"), is_ai_category(group).alias("is_ai"))


@query
def surrogate_keys(spark, sf_dir):
    company = company_key(F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string")))
    article = article_key(F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", company.alias("company_id"), article.alias("article_id"),
        observation_key(company, article, F.col("o_orderdate").cast("date"))
        .alias("arr_observation_id"))


# --- company names ------------------------------------------------------------------------------

def _customers(spark: SparkSession, sf_dir: str, written: Column) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", written.alias("company_name"))


def _resolved(rows: DataFrame, companies: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    return with_company(rows, companies, rules=rules, stage_out="stage").select(
        "c_custkey", "company_name_resolved", "stage")


@query
def entity_exact_alias(spark, sf_dir):
    number = F.col("c_nationkey").cast("string")
    written = (
        F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("\tNATION_"), number))
        .when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("nation_"), number))
        .when(F.col("c_custkey") % 4 == 2, F.concat(F.lit("Land "), number))
        .otherwise(F.concat(F.lit("Realm "), number)))
    rules = replace(
        DEFAULT_RULES,
        company_aliases={f"Land {i}": f"NATION_{i}" for i in range(25)} | {"Realm 1": "ATLANTIS"},
        unresolvable_companies=("Land 3", "nation_4"))
    return _resolved(_customers(spark, sf_dir, written), nation_companies(spark, sf_dir), rules)


@query
def entity_compact(spark, sf_dir):
    number = F.col("c_nationkey").cast("string")
    written = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Nation "), number)).otherwise(
        F.concat(F.lit("(na-tion) "), number, F.lit("!")))
    return _resolved(_customers(spark, sf_dir, written), nation_companies(spark, sf_dir))


@query
def entity_fuzzy(spark, sf_dir):
    number = F.col("c_nationkey").cast("string")
    written = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("NATION_"), number, F.lit("S"))).when(
        F.col("c_custkey") % 3 == 1, F.concat(F.lit("NTION_"), number)).otherwise(
        F.concat(F.lit("PLANET "), number))
    return _resolved(_customers(spark, sf_dir, written), nation_companies(spark, sf_dir))


@query
def entity_fuzzy_many(spark, sf_dir):
    """As many canonical names as customers, and a misspelling of each."""
    name = F.substring(F.sha1("c_name"), 1, 20)
    at = (F.col("c_custkey") % 20 + 1).cast("int")
    written = F.overlay(name, F.when(F.col("c_custkey") % 2 == 0, "").otherwise("zz"), at, F.lit(1))
    customers = table(spark, sf_dir, "customer")
    return _resolved(
        _customers(spark, sf_dir, written), customers.select(name.alias("company_name")))


# --- silver and gold ----------------------------------------------------------------------------

def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_articles(messy_orders(spark, sf_dir), nation_companies(spark, sf_dir))


@query
def silver_articles(spark, sf_dir):
    return silver.silver_articles(_cleaned(spark, sf_dir)).select(
        F.col("source_article_id").cast("bigint").alias("o_orderkey"), "article_id",
        "company_name_raw", "company_name_resolved", "company_id", "published_date",
        F.col("published_year").cast("bigint").alias("published_year"), "category_standardized",
        "arr_usd", "revenue_currency", "revenue_is_range", "arr_parse_status")


@query
def parse_errors(spark, sf_dir):
    return silver.parse_errors(_cleaned(spark, sf_dir))


@query
def unmatched_counts(spark, sf_dir):
    return silver.unmatched_names(messy_orders(spark, sf_dir), nation_companies(spark, sf_dir))


@query
def fact_valid(spark, sf_dir):
    return gold.fact_arr_observation(silver.silver_articles(_cleaned(spark, sf_dir)))


@query
def dim_enrichment(spark, sf_dir):
    articles = gold.dim_article(
        silver.silver_articles(_cleaned(spark, sf_dir)),
        gold.dim_company(nation_companies(spark, sf_dir)))
    return articles.select(
        F.col("source_article_id").cast("bigint").alias("o_orderkey"), "industry", "headquarters",
        "employee_count", F.col("founded_year").cast("bigint").alias("founded_year"), "is_public",
        "stock_ticker", "company_age", "company_size_category")


@query
def ai_export_filter(spark, sf_dir):
    articles = gold.dim_article(
        silver.silver_articles(_cleaned(spark, sf_dir)),
        gold.dim_company(nation_companies(spark, sf_dir)))
    return ai_articles_enriched(articles, rules=EXPORT_RULES).select(
        "article_id", "title", "company_name", "published_date", "category", "arr_usd", "industry",
        "company_age", "company_size_category")


# --- observations over time ---------------------------------------------------------------------

def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with each customer as a company, from the messy texts."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    rows = spread(orders).select(
        "o_orderkey", "o_custkey", revenue_text(whole_price(), key).alias("revenue_raw"),
        date_text(day, key).alias("published_date_raw"))
    parsed = with_parsed_revenue(
        with_parsed_date(rows, "published_date_raw", "_date"), "revenue_raw", "_money")
    return gold.fact_arr_observation(parsed.select(
        company_key(F.col("o_custkey").cast("string")).alias("company_id"),
        article_key(key.cast("string")).alias("article_id"),
        F.col("_date.date").alias("published_date"), F.col("_money.arr_usd").alias("arr_usd"),
        "revenue_raw", F.col("_money.currency_original").alias("revenue_currency"),
        F.col("_money.is_range").alias("revenue_is_range")))


@query
def latest_per_company(spark, sf_dir):
    return series.latest_observation(order_facts(spark, sf_dir)).select(
        "company_id", "observation_date", "arr_usd", "arr_observation_id")


@query
def latest_top5(spark, sf_dir):
    return series.latest_top(order_facts(spark, sf_dir), 5)


def _labels_to_long(df: DataFrame) -> DataFrame:
    return df.withColumns({
        c: F.col(c).cast("bigint") for c in ("published_year", "published_quarter")})


@query
def quarterly_last(spark, sf_dir):
    return _labels_to_long(series.quarterly_last(series.with_periods(order_facts(spark, sf_dir))))


@query
def quarterly_growth(spark, sf_dir):
    quarters = series.quarterly_last(series.with_periods(order_facts(spark, sf_dir)))
    growth = series.quarterly_growth(quarters).drop("previous_date")
    return _labels_to_long(growth).withColumn("change_ratio", F.round("change_ratio", 6))


@query
def quarterly_with_dimensions(spark, sf_dir):
    """Period labels and company names by joins to the two dimensions."""
    facts = order_facts(spark, sf_dir)
    companies = table(spark, sf_dir, "customer").select(
        company_key(F.col("c_custkey").cast("string")).alias("company_id"),
        F.col("c_name").alias("company_name"))
    articles = table(spark, sf_dir, "orders").select(
        article_key(F.col("o_orderkey").cast("string")).alias("article_id"),
        F.year("o_orderdate").alias("published_year"),
        F.quarter("o_orderdate").alias("published_quarter"))
    labelled = series.with_dimensions(facts, companies, articles)
    last = series.latest_observation(labelled, series.PERIOD)
    return _labels_to_long(last.select(
        "company_name", "published_year", "published_quarter", "observation_date", "arr_usd"))


@query
def series_one_company(spark, sf_dir):
    companies = table(spark, sf_dir, "customer").select(
        company_key(F.col("c_custkey").cast("string")).alias("company_id"),
        F.col("c_name").alias("company_name"))
    return series.company_series(order_facts(spark, sf_dir), companies, "Customer#000000007")


@query
def lineage(spark, sf_dir):
    articles = table(spark, sf_dir, "orders").select(
        article_key(F.col("o_orderkey").cast("string")).alias("article_id"),
        F.col("o_orderkey").cast("string").alias("source_article_id"),
        revenue_text(whole_price(), F.col("o_orderkey")).alias("revenue_raw"))
    bronze = messy_orders(spark, sf_dir).select(
        "article_id", "revenue", F.lit("orders").alias("source_file"),
        F.lit(None).cast("string").alias("source_hash"),
        F.lit(None).cast("timestamp").alias("ingested_at"))
    rows = series.lineage(order_facts(spark, sf_dir), articles, bronze)
    return rows.select(
        "arr_observation_id", F.col("source_article_id").cast("bigint").alias("o_orderkey"),
        "observation_date", "arr_usd", (F.col("source_revenue") == F.col("revenue_raw")).alias("same"))


@query
def quality_summary(spark, sf_dir):
    names = ("orders", "customer", "nation", "lineitem")
    return table_counts({name: table(spark, sf_dir, name) for name in names})


@query
def quality_duplicates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return duplicate_keys(orders, ["o_custkey", "day"])


# --- vectors ------------------------------------------------------------------------------------

def _first_vector(vectors: DataFrame) -> list[float]:
    return [float(x) for x in vectors.where("vec_id = 0").first()["embedding"]]


@query
def vector_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return find_similar(vectors, _first_vector(vectors), 10, id_column="vec_id")


@query
def vector_top3_all(spark, sf_dir):
    found = top_neighbours(table(spark, sf_dir, "embeddings"), 3, id_column="vec_id")
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query
def vector_hybrid(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    articles = vectors.select(
        F.col("vec_id").alias("article_id"),
        F.concat(F.lit("Vector "), F.col("vec_id").cast("string")).alias("title"),
        F.lit("c").alias("company_name_resolved"), (F.col("label") + 2000).alias("published_year"),
        F.concat(F.lit("L"), F.col("label").cast("string")).alias("category_standardized"),
        F.when(F.col("vec_id") % 2 == 0, "even").otherwise("odd").alias("industry"),
        (F.col("vec_id") * 1000).alias("arr_usd"), "embedding")
    found = hybrid_search(
        articles, _first_vector(vectors), 10, published_year_from=2001, published_year_to=2006,
        arr_min_usd=20_000, categories=["L1", "L2", "L3", "L4", "L9"], industries=["odd"])
    return found.select("article_id", "title", F.col("published_year").cast("bigint").alias(
        "published_year"), "category", "industry", "arr_usd", "similarity")


@query
def text_encoding(spark, sf_dir):
    """Encode every document in full; reports which buckets of each vector are filled and heavy.

    Weights are single-precision, so the report holds counts and positions, not rounded weights.
    """
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    encoded = encode_text(documents, F.col("text"), id_column="doc_id")
    vector = F.col("embedding")
    return encoded.select(
        "doc_id",
        F.size(F.filter(vector, lambda x: x > 0)).cast("bigint").alias("filled"),
        (F.array_position(vector, F.array_max(vector)) - 1).alias("top_bucket"),
        F.size(F.filter(vector, lambda x: x * F.lit(2.0) >= F.array_max(vector))).cast("bigint")
        .alias("heavy"))


@query
def encoding_text(spark, sf_dir):
    """The text that is encoded: title and summary, here language and text of each document."""
    text = article_text(F.nullif(F.col("lang"), F.lit("de")), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text).alias("text_md5"))


@query
def embeddings_roundtrip(spark, sf_dir):
    """Vectors to the table of vectors and back, and through JSON text."""
    folder = work_folder(spark, "vectors")
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("article_id"), "embedding")
    write_embeddings(vectors, folder)
    vector = F.col("embedding")
    parsed = F.transform(from_json(to_json(vector)), lambda x: x.cast("float"))
    total = F.aggregate(vector, F.lit(0.0), lambda t, x: t + x.cast("double"))
    return read_embeddings(spark, folder).select(
        F.col("article_id").cast("bigint").alias("vec_id"), F.size(vector).cast("bigint").alias("dimension"),
        F.round(total, 6).alias("total"), (parsed == vector).alias("same"))


# --- files and tables ---------------------------------------------------------------------------

@query
def provenance(spark, sf_dir):
    """Hashes of files whose content is known: the customers of each nation, a line each."""
    folder = work_folder(spark, "hashed")
    names = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda c: c["c_name"])
    table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.array_join(names, "\n").alias("value")).write.partitionBy("c_nationkey").text(folder)
    nation = F.regexp_extract("source_file", r"c_nationkey=(\d+)", 1).cast("bigint")
    return file_hashes(spark, folder).select(nation.alias("c_nationkey"), "source_hash")


@query
def csv_source(spark, sf_dir):
    """Raw articles through the CSV sink and the CSV source."""
    folder = work_folder(spark, "csv")
    messy = messy_orders(spark, sf_dir).withColumn(
        "title", F.concat(F.lit('He said "'), F.col("title"), F.lit('",\nthen left')))
    write_csv(messy, folder, "articles")
    rows = scan_articles(spark, f"{folder}/articles")
    return rows.select(
        F.col("article_id").cast("bigint").alias("o_orderkey"), "title", "revenue", "url", "category")


@query
def company_json_source(spark, sf_dir):
    """Customers as JSON objects keyed by name, one object per file, read back as companies."""
    folder = work_folder(spark, "json")
    entry = F.struct("c_name", F.struct(
        (F.col("c_nationkey") + 1950).alias("founded_year"),
        F.col("c_custkey").cast("string").alias("employee_count"),
        F.col("c_mktsegment").alias("industry"), (F.col("c_custkey") % 2 == 0).alias("is_public")))
    # at most a thousand customers share a file
    objects = table(spark, sf_dir, "customer").groupBy(
        F.floor(F.col("c_custkey") / 1000).alias("part")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    objects.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/companies")
    companies = read_companies(spark, f"{folder}/companies")
    return companies.select(
        "company_name", "founded_year", "employee_count", "industry", "is_public", "stock_ticker",
        (F.length("source_hash") == 40).alias("hashed"))


@query
def stored_tables(spark, sf_dir):
    """Gold written as typed tables, then queried by name with a pruned year."""
    folder = work_folder(spark, "tables")
    cleaned = materialise(_cleaned(spark, sf_dir), "cleaned")
    companies = gold.dim_company(nation_companies(spark, sf_dir))
    write_table(companies, folder, "dim_company")
    write_table(gold.dim_article(silver.silver_articles(cleaned), companies), folder, "dim_article")
    articles = read_table(spark, folder, "dim_article").where("published_year = 1997")
    return articles.groupBy("company_id").agg(
        F.count(F.lit(1)).alias("articles"), F.sum("arr_usd").alias("arr_usd")).join(
        read_table(spark, folder, "dim_company"), "company_id").select(
        "company_name", "articles", "arr_usd")


@query
def incremental_upsert(spark, sf_dir):
    """Orders arrive as files, a third of them again with a new amount, then the log is folded."""
    folder = work_folder(spark, "incremental")
    companies = nation_companies(spark, sf_dir)
    messy = messy_orders(spark, sf_dir)
    corrected = messy.where(F.col("article_id").cast("bigint") % 3 == 0).withColumn(
        "revenue", F.concat(F.lit("$"), F.col("article_id"), F.lit("K")))
    for step, rows in enumerate((messy, corrected)):
        write_csv(rows, f"{folder}/in", f"part={step}")
        start_ingest(spark, f"{folder}/in/*", companies, f"{folder}/out").awaitTermination()
        if step == 0:
            compact(spark, f"{folder}/out")
    return current_articles(spark, f"{folder}/out").select(
        F.col("source_article_id").cast("bigint").alias("o_orderkey"), "company_name_resolved",
        "arr_usd", "arr_parse_status")
