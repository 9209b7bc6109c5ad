import re

from corpus_pipeline import decontaminate
from obslake.llm.templates import TOKEN, find_copies, find_leaks

ITEM = "The Quick Brown Fox Jumps Over The Lazy Dog While Two Grey Cats Watch From Afar"
NUMBERS = "12 plus 7 is 19 and 3 times 4 is 12 or 5 less 2 is 3"
SHORT = "What is Boron?"


def tokens(text):
    return re.findall(TOKEN.replace(r"\p{L}", r"[^\W\d_]"), (text or "").lower())


def brute_force(documents, items):
    out = set()
    for d, text in documents:
        held = tokens(text)
        for i, item in items:
            w = tokens(item)
            n = min(13, len(w))
            wanted = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if n else set()
            if any(tuple(held[k:k + n]) in wanted for k in range(len(held) - n + 1)):
                out.add((d, i))
    return out


def found(spark, documents, items):
    rows = find_copies(spark.createDataFrame(documents, "doc_id long, text string"),
                       spark.createDataFrame(items, "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]) for r in rows.collect()}


def test_copies_that_have_no_template_window(spark):
    items = [(1, ITEM), (2, NUMBERS), (3, SHORT), (4, None), (5, "...")]
    documents = [(1, f"intro {ITEM.upper()} end"), (2, f"x {NUMBERS} y"), (3, f"Now, {SHORT.upper()} No."),
                 (4, "the quick brown fox is here"), (5, None), (None, f"{ITEM.lower()} {SHORT}"), (7, "what is")]
    expected = {(1, 1), (2, 2), (3, 3), (None, 1), (None, 3)}
    assert found(spark, documents, items) == expected == brute_force(documents, items)
    templates = find_leaks(spark.createDataFrame(documents, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string"))
    assert not {(r["doc_id"], r["item_id"]) for r in templates.collect()} & {(1, 1), (3, 3)}


def test_an_item_of_which_thirteen_tokens_are_copied(spark):
    words = ITEM.split()
    documents = [(1, " ".join(words[:13])), (2, " ".join(words[:12]) + " x " + " ".join(words[12:]))]
    assert found(spark, documents, [(1, ITEM)]) == {(1, 1)}


def test_no_rows(spark):
    assert found(spark, [], [(1, ITEM)]) == set() == found(spark, [(1, ITEM)], [])


def test_the_pipeline_drops_a_copy_in_other_case(spark, tmp_path):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, ITEM.upper()), (2, "something else")], "doc_id long, text string")
    assert [r["doc_id"] for r in decontaminate(spark, docs, str(tmp_path)).collect()] == [2]
