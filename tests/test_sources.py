"""CSV and JSON sources, sinks and catalog tables."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from obslake.functions.category import is_ai_category, standardize_category
from obslake.functions.company import company_age, lenient_boolean, lenient_long, size_category
from obslake.functions.keys import article_key, company_key, observation_key
from obslake.functions.text import strip
from obslake.rules import CATEGORY_GROUPS, NULL_TOKENS
from obslake.sinks.tables import save_table, write_csv, write_table
from obslake.sources.files import read_articles, read_companies, scan_articles
from obslake.sources.tables import read_embeddings, read_table


def test_csv_cells(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(
        'article_id , title,company_name,extra\n'
        '1,"He said ""no"", twice",Café,x\n'
        '2,"two\nlines",null,\n'
        '3,N/A,"N/A", N/A\n'
        '4,back\\slash,NA\n'
        '\n', encoding="utf-8")
    got = {r["article_id"]: r for r in scan_articles(spark, str(path)).collect()}
    assert got["1"]["title"] == 'He said "no", twice' and got["1"]["company_name"] == "Café"
    assert got["2"]["title"] == "two\nlines" and got["2"]["company_name"] == ""
    assert got["2"]["extra"] == ""
    assert got["3"]["title"] == "" and got["3"]["company_name"] == "" and got["3"]["extra"] == " N/A"
    assert got["4"]["title"] == "back\\slash" and got["4"]["extra"] == ""
    assert len(got) == 4


def test_byte_order_mark_is_no_part_of_the_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("article_id,title\n1,x\n", encoding="utf-8-sig")
    for multi_line in (True, False):
        rows = scan_articles(spark, str(path), multi_line).select("article_id", "title").collect()
        assert [tuple(r) for r in rows] == [("1", "x")]


def test_every_null_token_is_folded(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("article_id,title\n" + "".join(f"{i},{t}\n" for i, t in enumerate(NULL_TOKENS)))
    assert {r["title"] for r in scan_articles(spark, str(path)).collect()} == {""}
    assert len(NULL_TOKENS) == 18


def test_folder_of_files_has_a_hash_per_file(spark, tmp_path):
    digests = {}
    for name in ("a.csv", "b b.csv"):
        path = tmp_path / name
        path.write_text(f"article_id,title\n1,{name}\n")
        digests[name] = hashlib.sha1(path.read_bytes()).hexdigest()
    rows = read_articles(spark, str(tmp_path), multi_line=False).collect()
    assert {r["title"]: r["source_hash"] for r in rows} == digests


def test_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("article_id,title\n1,x\n")
    (tmp_path / "b.csv").write_text("title,article_id\nx,1\n")
    with pytest.raises(Exception, match="header"):
        scan_articles(spark, str(tmp_path)).collect()


def test_company_json(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({
        "A": {"founded_year": 2001, "employee_count": "12", "is_public": True, "industry": "X"},
        "B": {"founded_year": "2001.0", "employee_count": "many", "stock_ticker": None},
        "C": {},
    }))
    got = {r["company_name"]: r for r in read_companies(spark, str(path)).collect()}
    assert (got["A"]["founded_year"], got["A"]["employee_count"], got["A"]["is_public"]) == (2001, 12, True)
    assert (got["B"]["founded_year"], got["B"]["employee_count"], got["B"]["is_public"]) == (2001, None, None)
    assert got["C"]["industry"] is None
    assert got["A"]["source_hash"] == hashlib.sha1(path.read_bytes()).hexdigest()


def test_categories(spark):
    cases = {**CATEGORY_GROUPS, "Something New": "UNKNOWN", "": "UNKNOWN", None: "UNKNOWN",
             "cloud": "UNKNOWN", " Cloud ": "CLOUD_COMPUTING", " SaaS\t": "SOFTWARE"}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    group = standardize_category(F.col("c"))
    got = df.select("c", group.alias("g"), is_ai_category(group).alias("ai")).collect()
    assert {r["c"]: r["g"] for r in got} == cases
    assert all(r["ai"] == (r["g"] == "AI_ML") for r in got)
    assert len(CATEGORY_GROUPS) == 19


def test_company_attributes(spark):
    df = spark.createDataFrame(
        [(9_999,), (10_000,), (30_000,), (30_001,), (None,)], "n bigint")
    assert [r[0] for r in df.select(size_category(F.col("n"))).collect()] == [
        "Small", "Medium", "Medium", "Large", None]
    ages = spark.createDataFrame([(2015, 2023), (2024, 2020), (None, 2023), (2015, None)], "f int, y int")
    assert [r[0] for r in ages.select(company_age(F.col("f"), F.col("y"))).collect()] == [8, -4, None, None]
    texts = spark.createDataFrame([("12",), ("12.0",), ("12.5",), ("x",), ("true",), (None,)], "t string")
    assert [tuple(r) for r in texts.select(
        lenient_long(F.col("t")), lenient_boolean(F.col("t"))).collect()] == [
            (12, None), (12, None), (None, None), (None, None), (None, True), (None, None)]


def test_keys(spark):
    df = spark.createDataFrame(
        [("OpenAI", "ART0001", dt.date(2023, 1, 2)), (None, "ART0001", dt.date(2023, 1, 2))],
        "c string, a string, d date")
    got = df.select(company_key(F.col("c")), article_key(F.col("a")),
                    observation_key(F.col("c"), F.col("a"), F.col("d"))).collect()
    digest = hashlib.sha1(b"OpenAI|ART0001|2023-01-02").hexdigest()[:24].upper()
    assert tuple(got[0]) == ("COMP-A19EE5A9FDC19109", "ART-77B8C33CF8A99CF7", f"ARR-{digest}")
    assert tuple(got[1]) == (None, "ART-77B8C33CF8A99CF7", None)


def test_strip_equals_python(spark):
    texts = [chr(c) + "x" + chr(c) for c in range(1, 0x3001) if chr(c).isspace()] + ["​x", " ", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["s"] for r in df.select("i", strip(F.col("t")).alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == [t.strip() for t in texts]


def test_tables_are_matched_by_name(spark, tmp_path):
    df = spark.createDataFrame([("x", 3, "c")], "industry string, founded_year bigint, company_id string")
    write_table(df, str(tmp_path), "dim_company")
    got = read_table(spark, str(tmp_path), "dim_company").first()
    assert (got["company_id"], got["industry"], got["founded_year"], got["company_name"]) == (
        "c", "x", 3, None)
    vectors = spark.createDataFrame([([0.5, 1.0], "a")], "embedding array<double>, article_id string")
    write_table(vectors, str(tmp_path), "embeddings")
    assert tuple(read_embeddings(spark, str(tmp_path)).first()) == ("a", [0.5, 1.0])


def test_bucketed_catalog_tables_join_without_a_shuffle(spark):
    facts = spark.createDataFrame(
        [(f"a{i}", i) for i in range(50)], "article_id string, arr_usd bigint")
    save_table(facts, "fact_arr_observation", bucket_by="article_id", buckets=4)
    save_table(facts.select("article_id"), "silver_articles", bucket_by="article_id", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("default.fact_arr_observation").join(spark.table("default.silver_articles"), "article_id")
        assert joined.count() == 50
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE default.fact_arr_observation")
        spark.sql("DROP TABLE default.silver_articles")


def test_csv_sink_writes_arrays_as_json(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0, 0.5], None)], "id string, v array<float>, n bigint")
    write_csv(df, str(tmp_path), "t")
    got = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "t")).first()
    assert (got["v"], got["n"]) == ("[1.0,0.5]", None)


@pytest.mark.parametrize("multi_line", [True, False])
def test_surplus_cells_fail_and_missing_ones_do_not(spark, tmp_path, multi_line):
    good = tmp_path / "good.csv"
    good.write_text('a,b,c\n1,2\n3,"4,""x",5\n6,7,8,,\n')
    rows = [tuple(r)[:3] for r in scan_articles(spark, str(good), multi_line).collect()]
    assert sorted(rows) == [("1", "2", ""), ("3", '4,"x', "5"), ("6", "7", "8")]
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b,c\n1,2,3\n4,5,6,7\n")
    with pytest.raises(Exception, match="too many cells in .*bad.csv"):
        scan_articles(spark, str(bad), multi_line).select("a").collect()


def test_company_files_are_never_lost_or_multiplied(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"One": {"headquarters": "old"}, "Two": "no object", "One": {"headquarters": "new", "founded_year": 1}}')
    (tmp_path / "b.json").write_text('{"Two": {"headquarters": "x"}, "Three": {"founded_year": "bad"}}')
    got = {r["company_name"]: (r["headquarters"], r["founded_year"]) for r in read_companies(spark, str(tmp_path)).collect()}
    assert got == {"One": ("new", 1), "Two": ("x", None), "Three": (None, None)}
    assert read_companies(spark, str(tmp_path)).count() == 3
    (tmp_path / "c.json").write_text('{"Four": {"headquarters": "y"}, "Fi')
    with pytest.raises(Exception, match="not a JSON object: .*c.json"):
        read_companies(spark, str(tmp_path)).collect()


def test_dim_company_has_a_row_per_name(spark):
    from obslake.plans.gold import dim_company
    from obslake.schemas import BRONZE_COMPANIES, conform

    rows = spark.createDataFrame(
        [("A", "x", "f1"), ("A", "y", "f2"), ("B", None, "f1")], "company_name string, headquarters string, source_file string")
    rows = conform(rows.withColumns({n: F.lit(None) for n in BRONZE_COMPANIES.names if n not in rows.columns}), BRONZE_COMPANIES)
    got = sorted((r["company_name"], r["headquarters"]) for r in dim_company(rows).collect())
    assert got == [("A", "y"), ("B", None)]
