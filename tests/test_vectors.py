"""Similarity, search, neighbours and encoding against NumPy."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obslake.functions.vectors import cosine, from_json, literal, norm, to_json
from obslake.operators import neighbours
from obslake.operators.encode import LexicalEncoder, article_text, encode_text
from obslake.operators.neighbours import approximate_neighbours, as_lists, top_neighbours
from obslake.operators.search import article_filter, encode_query, find_similar, hybrid_search

SCHEMA = "article_id string, embedding array<float>"


def frame(spark, matrix, ids=None):
    ids = ids or [f"a{i:04d}" for i in range(len(matrix))]
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, matrix)], SCHEMA)


def unit(rng, n, d):
    m = rng.normal(size=(n, d)).astype(np.float32)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def brute_force(matrix, k):
    m = matrix.astype(np.float64)
    m = m / np.linalg.norm(m, axis=1, keepdims=True).clip(min=1e-12)
    s = np.round(m @ m.T, 12)
    np.fill_diagonal(s, -np.inf)
    result = set()
    for i in range(len(m)):
        order = [j for j in np.lexsort((np.arange(len(m)), -s[i])) if j != i][:k]
        result |= {(f"a{i:04d}", r + 1, f"a{j:04d}", round(float(s[i, j]), 6))
                   for r, j in enumerate(order)}
    return result


def rows_of(df):
    return {(r["id"], r["rank"], r["neighbour"], round(r["similarity"], 6)) for r in df.collect()}


def test_expressions(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    a, z = F.col("a"), F.col("z")
    got = row.select(norm(a), cosine(a, literal([3, 4])), cosine(a, z), to_json(a),
                     from_json(to_json(a))).first()
    assert tuple(got) == (5.0, 1.0, 0.0, "[3.0,4.0]", [3.0, 4.0])


def test_find_similar(spark):
    m = unit(np.random.default_rng(1), 300, 16)
    got = find_similar(frame(spark, m), m[7], 5).collect()
    scores = m.astype(np.float64) @ m[7].astype(np.float64)
    best = np.argsort(-scores)[:5]
    assert [r["article_id"] for r in got] == [f"a{i:04d}" for i in best]
    assert np.allclose([r["similarity"] for r in got], scores[best], atol=1e-6)


def test_find_similar_is_a_top_k_plan(spark):
    df = find_similar(frame(spark, unit(np.random.default_rng(1), 10, 4)), [1.0, 0, 0, 0], 2)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("block_rows", [10_000, 40, 7])
def test_neighbours_equal_brute_force(spark, block_rows):
    m = unit(np.random.default_rng(2), 150, 8)
    assert rows_of(top_neighbours(frame(spark, m), block_rows=block_rows)) == brute_force(m, 3)


def test_neighbours_among_many_copies(spark):
    m = unit(np.random.default_rng(3), 120, 8)
    m[40:80] = m[40]  # a third of all rows are copies of one vector
    m[100] = 0.0
    assert rows_of(top_neighbours(frame(spark, m), block_rows=25)) == brute_force(m, 3)


@pytest.mark.parametrize("rows_at_once,others_at_once", [(1, 1), (7, 3), (64, 50)])
def test_tiles_of_any_size_find_the_same(monkeypatch, rows_at_once, others_at_once):
    """The best of a cell straight from its tiles: copies tie by position, no row is its own neighbour."""
    monkeypatch.setattr(neighbours, "ROWS_AT_ONCE", rows_at_once)
    monkeypatch.setattr(neighbours, "OTHERS_AT_ONCE", others_at_once, raising=False)
    m = unit(np.random.default_rng(8), 120, 8)
    m[40:80] = m[40]
    ids = pa.array([f"a{i:04d}" for i in range(len(m))])
    table = pa.table({"id": ids, "vector": pa.array(list(m), pa.list_(pa.float32())), "block": [0] * len(m)})
    found = neighbours._grid_cell(3)((pa.scalar(0), pa.scalar(0)), table).to_pandas()
    found = found.sort_values(["id", "score", "neighbour"], ascending=[True, False, True])
    found["rank"] = found.groupby("id").cumcount() + 1
    assert set(zip(found["id"], found["rank"], found["neighbour"], found["score"].round(6))) == brute_force(m, 3)


@pytest.mark.parametrize("copies", [False, True])
def test_memory_of_a_cell_does_not_follow_the_block(copies):
    m = unit(np.random.default_rng(9), 8_000, 4)
    if copies:
        m[:] = m[0]
    table = pa.table({"id": range(len(m)), "vector": pa.array(list(m), pa.list_(pa.float32())),
                      "block": np.arange(len(m)) % 2})
    tracemalloc.start()
    found = neighbours._grid_cell(3)((pa.scalar(0), pa.scalar(1)), table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 3 * len(m)
    assert peak < (60 << 20 if copies else 20 << 20)


def test_few_rows_have_few_neighbours(spark):
    m = unit(np.random.default_rng(4), 3, 4)
    assert rows_of(top_neighbours(frame(spark, m))) == brute_force(m, 3)
    assert top_neighbours(frame(spark, m[:1])).count() == 0


def test_neighbour_lists(spark):
    m = unit(np.random.default_rng(5), 30, 8)
    rows = frame(spark, m)
    lists = {r["article_id"]: r["top_similar_articles"]
             for r in as_lists(top_neighbours(rows), rows).collect()}
    alone = frame(spark, m[:1])
    assert [r["top_similar_articles"] for r in as_lists(top_neighbours(alone), alone).collect()] == [[]]
    expected = brute_force(m, 3)
    assert len(lists) == 30
    assert all((i, r + 1, n) in {e[:3] for e in expected}
               for i, names in lists.items() for r, n in enumerate(names))


def test_approximate_search_finds_planted_copies(spark):
    rng = np.random.default_rng(6)
    m = unit(rng, 200, 16)
    m[100:] = m[:100] + rng.normal(scale=0.01, size=(100, 16)).astype(np.float32)
    got = rows_of(approximate_neighbours(frame(spark, m), k=1, block_rows=30))
    best = {e[0]: e[2:] for e in brute_force(m, 1)}
    found = {i: (n, s) for i, _, n, s in got}
    assert all(found[i] == best[i] for i in found if found[i][1] > 0.99)
    assert sum(found.get(f"a{i:04d}") == best[f"a{i:04d}"] for i in range(200)) >= 190


ARTICLES = [  # id, year, usd, category, industry, vector
    ("a1", 2021, 10, "AI_ML", "AI/ML", [1.0, 0.0]),
    ("a2", 2022, 60, "AI_ML", None, [0.0, 2.0]),
    ("a3", 2023, 70, "FINTECH", "FinTech", [0.0, 0.0]),
    ("a4", 2024, 80, "AI_ML", "FinTech", None),
    ("a5", None, None, "AI_ML", "AI/ML", [1.0, 1.0]),
]


@pytest.fixture(scope="module")
def articles(spark):
    rows = [(i, "t", "c", y, c, n, u, v) for i, y, u, c, n, v in ARTICLES]
    return spark.createDataFrame(
        rows, "article_id string, title string, company_name_resolved string, published_year int, "
        "category_standardized string, industry string, arr_usd bigint, embedding array<float>")


def test_hybrid_search(articles):
    got = hybrid_search(articles, [1.0, 0.0], 10)
    assert got.columns == ["article_id", "title", "company_name", "published_year", "category",
                           "industry", "arr_usd", "similarity"]
    assert [(r["article_id"], r["similarity"]) for r in got.collect()] == [
        ("a1", 1.0), ("a5", 0.707107), ("a2", 0.0), ("a3", 0.0), ("a4", 0.0)]
    assert [r[0] for r in hybrid_search(articles, [1.0, 0.0], 1).collect()] == ["a1"]


def test_hybrid_filters(articles):
    def ids(**conditions):
        return [r[0] for r in articles.where(article_filter(**conditions)).collect()]

    assert ids(categories=[], industries=[]) == ["a1", "a2", "a3", "a4", "a5"]
    assert ids(published_year_from=2022, published_year_to=2023) == ["a2", "a3"]
    assert ids(arr_min_usd=60) == ["a3", "a4"]
    assert ids(categories=["AI_ML"], industries=["AI/ML", "FinTech"]) == ["a1", "a4", "a5"]
    assert hybrid_search(articles, [1.0, 0.0], published_year_from=2030).count() == 0


def test_encoding(spark):
    rows = [("a", "New round", "for  Acme"), ("b", None, "new ROUND"), ("c", "", ""),
            ("d", None, None)]
    df = spark.createDataFrame(rows, "article_id string, title string, summary string")
    text = article_text(F.col("title"), F.col("summary"))
    assert [r[0] for r in df.select(text).collect()] == ["New round for  Acme", "new ROUND", "", ""]
    got = {r[0]: np.array(r[1]) for r in encode_text(df, text).collect()}
    assert {len(v) for v in got.values()} == {384}
    assert np.allclose([np.linalg.norm(got[i]) for i in "abcd"], [1, 1, 0, 0])
    assert np.allclose(got["b"], LexicalEncoder()(["round new"])[0])
    assert np.allclose(encode_query("round new", LexicalEncoder), got["b"])


def test_other_encoders(spark):
    class Lengths:
        def __call__(self, texts):
            return np.array([[len(t), 0.0] for t in texts])

    df = spark.createDataFrame([(1, "abc")], "article_id bigint, t string")
    got = encode_text(df, F.col("t"), Lengths)
    assert got.schema.simpleString() == "struct<article_id:bigint,embedding:array<float>>"
    assert got.first()["embedding"] == [1.0, 0.0]


@pytest.mark.parametrize("rows, blocks", [(0, 1), (1, 1), (300, 2), (2000, 4), (100_000, 7)])
def test_a_grid_has_a_cell_for_each_core(rows, blocks):
    from obslake.operators.neighbours import BLOCK_ROWS, grid_size

    assert grid_size(rows, BLOCK_ROWS, 8) == blocks


def test_encoder_gets_few_texts_at_a_time(spark):
    """However many rows Spark hands over at once; the vectors are those of the whole batch."""
    class Watched(LexicalEncoder):
        def __call__(self, texts):
            assert 0 < len(texts) <= 64
            return super().__call__(texts)

    texts = [f"round {i} new {i % 7}" for i in range(1_000)]
    rows = spark.createDataFrame([(f"a{i:04d}", t) for i, t in enumerate(texts)], "article_id string, title string")
    got = encode_text(rows.coalesce(1), F.col("title"), Watched).orderBy("article_id").collect()
    assert [r["article_id"] for r in got] == [f"a{i:04d}" for i in range(1_000)]
    assert np.allclose([r["embedding"] for r in got], LexicalEncoder()(texts), atol=1e-6)


def test_encoder_remembers_few_words():
    encoder = LexicalEncoder()
    encoder([" ".join(f"w{i}" for i in range(k, k + 1_000)) for k in range(0, 120_000, 1_000)])
    assert len(encoder._buckets) <= 50_000
