import pytest
from pyspark.errors import StreamingQueryException

from obslake.schemas import RAW_ARTICLES
from obslake.sources.files import read_companies, scan_articles
from obslake.streaming.incremental import current_articles, start_ingest
from tests.news import write_companies

WIDTH = len(RAW_ARTICLES.names)


def write(path, *rows):
    path.parent.mkdir(exist_ok=True)
    path.write_text("\n".join([",".join(RAW_ARTICLES.names), *rows]) + "\n")


def row(number, surplus=""):
    return ",".join([str(number)] + ["x"] * (WIDTH - 1)) + surplus


def ingest(spark, place):
    write_companies(place / "companies.json")
    companies = read_companies(spark, str(place / "companies.json"))
    start_ingest(spark, str(place / "in"), companies, str(place / "out")).awaitTermination()


@pytest.mark.parametrize("surplus", [",more", "," * (WIDTH + 5) + "far"])
def test_surplus_cells_of_an_increment_fail(spark, tmp_path, surplus):
    write(tmp_path / "in" / "a.csv", row(1), row(2, surplus))
    with pytest.raises(StreamingQueryException):
        ingest(spark, tmp_path)
    assert current_articles(spark, str(tmp_path / "out")).count() == 0


def test_missing_and_empty_surplus_cells_are_no_error(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", row(1, "," * (WIDTH + 5)), "2,x", row(3))
    ingest(spark, tmp_path)
    assert current_articles(spark, str(tmp_path / "out")).count() == 3


def test_far_surplus_cells_fail_the_source(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", row(1, "," * (WIDTH + 5) + "far"))
    with pytest.raises(Exception, match="too many cells"):
        scan_articles(spark, str(tmp_path / "in")).collect()
