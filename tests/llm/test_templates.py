import pytest
import regex

from obslake.llm import templates
from tests.llm.conftest import TEXTS

QUESTION = ("Anna buys 12 apples for 3 dollars each and Bert buys 12 pears, so how many pieces of fruit "
            "do Anna and Bert have after they walk 5 km home from the market")


def leaks(spark, docs, items):
    found = templates.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]): r["exact"] for r in found}


@pytest.mark.parametrize("text, exact", [
    (QUESTION, True),
    ("some words in front " + QUESTION + " and some words behind", True),
    # other names, numbers and units, exchanged alike wherever they stand
    (QUESTION.replace("Anna", "Zoe").replace("Bert", "Yan").replace("12", "47").replace("3 ", "9 ").replace("km", "miles"), False),
    # one of two equal numbers is another: not the question with other values
    (QUESTION.replace("12 pears", "13 pears"), None),
    # two names became one
    (QUESTION.replace("Bert", "Anna"), None),
    ("nothing of the kind is asked here, there are 12 words and Anna", None),
])
def test_reparameterised_questions(spark, text, exact):
    assert leaks(spark, [(1, text)], [(7, QUESTION)]).get((1, 7)) == exact


def test_half_an_item_is_a_leak_and_a_phrase_is_not(spark):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    item = " ".join(words)
    docs = [(1, " ".join(words[:36])), (2, " ".join(words[20:33])), (3, " ".join(words[:10])), (4, " ".join(words[:12]))]
    assert set(leaks(spark, docs, [(1, item)])) == {(1, 1), (2, 1)}


def test_kinds_and_tokens(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("On 3,500.25 km it is 5 Km, m and 7m of Öl",)], "text string")
    raw = templates.tokens(F.col("text"))
    row = df.select(raw.alias("raw")).select("raw", templates.kinds(F.col("raw")).alias("k")).first()
    assert row["raw"] == ["On", "3,500.25", "km", "it", "is", "5", "Km", "m", "and", "7", "m", "of", "Öl"]
    assert row["k"] == [2, 1, 3, 0, 0, 1, 3, 0, 0, 1, 3, 0, 2]


def test_awkward_texts(spark, awkward, nothing):
    bench = awkward.select(awkward["doc_id"].alias("item_id"), "text")
    rows = templates.find_leaks(awkward, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert {(1, 6), (6, 1), (1, 1), (2, 2), (None, None)} <= got
    assert len(rows) == len(got)
    empty = {i for i, t in TEXTS if len(regex.findall(templates.TOKEN, t or "")) < 8}
    assert not any(d in empty or i in empty for d, i in got)
    assert templates.find_leaks(nothing, bench).collect() == []
    assert templates.find_leaks(awkward, nothing.select(nothing["doc_id"].alias("item_id"), "text")).collect() == []


def test_many_items_of_one_template(spark):
    items = [(k, QUESTION.replace("12", str(100 + k))) for k in range(30)]
    got = leaks(spark, [(1, items[4][1])], items)
    assert got == {(1, k): k == 4 for k in range(30)}


def test_no_python_on_the_main_path(spark, documents):
    found = templates.find_leaks(documents, spark.createDataFrame([(1, QUESTION)], "item_id long, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
