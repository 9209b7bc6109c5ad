"""Messy articles made from the given tables: known numbers and dates are written as text.

``orders`` plays the articles, ``nation`` or ``customer`` the companies. The text is built from
integers, so what it means is known from the table and never from the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_price() -> Column:
    return F.floor("o_totalprice").cast("bigint")


def with_commas(n: Column) -> Column:
    return F.format_number(n, 0)


def with_point(n: Column, digits: int) -> Column:
    """n / 10^digits with exactly that many decimals."""
    base = F.lit(10**digits).cast("bigint")
    decimals = F.lpad((n % base).cast("string"), digits, "0")
    return F.concat(((n - n % base) / base).cast("bigint").cast("string"), F.lit("."), decimals)


def choose(selector: Column, options: list[Column]) -> Column:
    """The option whose position equals the selector."""
    result = F.when(selector == 0, options[0])
    for i, option in enumerate(options[1:], start=1):
        result = result.when(selector == i, option)
    return result


def revenue_text(n: Column, key: Column) -> Column:
    commas = with_commas(n)
    return choose(key % 10, [
        F.concat(F.lit("$"), commas),
        F.concat(with_point(n, 3), F.lit("K")),
        F.concat(F.lit("$"), with_point(n, 6), F.lit(" million")),
        F.concat(F.lit("€"), commas),
        F.concat(F.lit("£"), commas),
        F.concat(F.lit("¥"), commas),
        F.concat(F.lit("$"), n.cast("string"), F.lit(" - $"), (n + 2000).cast("string")),
        F.lit("Not disclosed"),
        F.lit("N/A"),
        F.lit("garbage"),
    ])


def tens(key: Column) -> Column:
    return F.floor(key / 10).cast("bigint")


def date_text(day: Column, key: Column) -> Column:
    return choose(tens(key) % 7, [
        F.date_format(day, "yyyy-MM-dd"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z")),
        F.date_format(day, "MM/dd/yyyy"),
        F.date_format(day, "MM-dd-yyyy"),
        F.date_format(day, "MMMM d, yyyy"),
        F.date_format(day, "d MMM yyyy"),
        F.lit("not a date"),
    ])


def category_text(priority: Column) -> Column:
    return (
        F.when(priority == "1-URGENT", "Machine Learning")
        .when(priority == "2-HIGH", " Cloud ")
        .when(priority == "3-MEDIUM", "FinTech")
        .when(priority == "4-NOT SPECIFIED", "saas")
    )


def company_text(customer: Column) -> Column:
    """A nation's name in four spellings; one name in 25 belongs to no nation."""
    number = (customer % 25).cast("string")
    turn = F.floor(customer / 25).cast("bigint")
    spelled = choose(turn % 4, [
        F.concat(F.lit(" NATION_"), number, F.lit(" ")),
        F.concat(F.lit("nation_"), number),
        F.concat(F.lit("Nation-"), number),
        F.concat(F.lit("NATION_"), number, F.lit("S")),
    ])
    return F.when(customer % 25 == 24, F.concat(F.lit("GHOST "), (turn % 3).cast("string"))).otherwise(
        spelled)


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles, one per order."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    orders = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority"))
    return orders.select(
        key.cast("string").alias("article_id"),
        F.concat(F.lit("Order "), key.cast("string")).alias("title"),
        company_text(F.col("o_custkey")).alias("company_name"),
        date_text(day, key).alias("published_date"),
        category_text(F.col("o_orderpriority")).alias("category"),
        revenue_text(whole_price(), key).alias("revenue"),
        F.col("o_orderstatus").alias("summary"),
        F.lit(None).cast("string").alias("url"),
        F.col("o_custkey").cast("string").alias("author"),
        F.lit(None).cast("string").alias("word_count"),
    )


def nation_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze_companies made from ``nation``."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("company_name"),
        (key + 1950).cast("bigint").alias("founded_year"),
        F.concat(F.lit("Region "), F.col("n_regionkey").cast("string")).alias("headquarters"),
        F.when(key != 7, key * 2000).cast("bigint").alias("employee_count"),
        F.when(F.col("n_regionkey") == 1, "AI/ML").otherwise("FinTech").alias("industry"),
        (key % 2 == 0).alias("is_public"),
        F.when(key % 2 == 0, F.concat(F.lit("N"), key.cast("string"))).alias("stock_ticker"),
    )
