"""Company names: every stage of the resolution, and the fuzzy join against brute force."""

import random

import pandas as pd
import pytest

from obslake.operators import fuzzy, resolve
from obslake.operators.fuzzy import best_fuzzy_match, indel_ratio
from obslake.operators.resolve import resolve_names, with_company
from obslake.session import materialise
from tests.companies import COMPANY_NAMES

# Written text -> expected result.
RESOLVED = {
    "AWS": ("Amazon Web Services", "alias"),
    "Amazon Web Services (AWS)": ("Amazon Web Services", "alias"),
    "Azure": ("Microsoft", "alias"),
    "Microsoft Azure": ("Microsoft", "alias"),
    "DeepMind": ("Google DeepMind", "alias"),
    "Google Deepmind": ("Google DeepMind", "alias"),
    "Nvidia": ("NVIDIA", "alias"),
    "NVIDIA Corporation": ("NVIDIA", "alias"),
    "Open AI": ("OpenAI", "alias"),
    "OpenAI Inc.": ("OpenAI", "alias"),
    "Data Robot": ("DataRobot", "alias"),
    "Mongo DB": ("MongoDB", "alias"),
    "CloudFlare": ("Cloudflare", "alias"),
    "Palantir Technologies": ("Palantir", "alias"),
    "The Boring Company / SpaceX": ("SpaceX", "alias"),
    "Facebook AI Research": ("Meta AI", "alias"),
    "OpenAI": ("OpenAI", "exact"),
    " Databricks ": ("Databricks", "exact"),
    "OPENAI": ("OpenAI", "case_insensitive"),
    "scale-ai": ("Scale AI", "compact"),
    "Mongo-DB": ("MongoDB", "compact"),
    "AI Scale": ("Scale AI", "fuzzy"),
    "Snowflakes": ("Snowflake", "fuzzy"),
    "CloudFare": ("Cloudflare", "fuzzy"),
    "Databrick": ("Databricks", "fuzzy"),
    "Conflunt": ("Confluent", "fuzzy"),
    "Elastics": ("Elastic", "fuzzy"),
    "Teslaa": ("Tesla", "fuzzy"),
    "Ubers": ("Uber", "fuzzy"),
}
UNRESOLVED = ["Cohere", "xAI", "Mistral AI", "Perplexity AI", "Hugging Face", "Palantyr", "Nvidea",
              "microsoft corp", "Meta", "aws", "azure", "", "   ", None, "!!!"]


@pytest.fixture(scope="module")
def companies(spark):
    return spark.createDataFrame([(n,) for n in COMPANY_NAMES], "company_name string")


def test_every_stage(spark, companies):
    names = [*RESOLVED, *UNRESOLVED, *COMPANY_NAMES]
    rows = spark.createDataFrame([(n,) for n in names], "company_name string")
    got = with_company(rows, companies, stage_out="stage").collect()
    assert len(got) == len(names)
    result = {r["company_name"]: (r["company_name_resolved"], r["stage"]) for r in got}
    assert {n: result[n] for n in RESOLVED} == RESOLVED
    assert {n: result[n] for n in UNRESOLVED} == dict.fromkeys(UNRESOLVED, (None, None))
    assert all(result[n][0] == n for n in COMPANY_NAMES)


def test_alias_needs_its_target(spark):
    names = spark.createDataFrame([("Azure",), ("AWS",)], "name string")
    canonicals = spark.createDataFrame([("Tesla",)], "canonical string")
    assert resolve_names(names, canonicals).count() == 0


def test_folded_keys_go_to_the_first_name(spark):
    names = spark.createDataFrame([("scale ai",), ("SCALE.AI",)], "name string")
    canonicals = spark.createDataFrame([("Scale AI",), ("SCALE AI",), ("ScaleAI",)], "canonical string")
    got = {r["name"]: r["canonical"] for r in resolve_names(names, canonicals).collect()}
    assert got == {"scale ai": "SCALE AI", "SCALE.AI": "SCALE AI"}


def test_ratio_anchors():
    assert indel_ratio("palantyr", "palantir") == 87.5
    assert round(indel_ratio("ubers", "uber"), 3) == 88.889
    assert indel_ratio("ai scale", "ai scale") == 100.0
    assert indel_ratio("abc", "xyz") == 0.0


@pytest.mark.parametrize("threshold,settings", [
    (88.0, {}), (75.0, {}),
    (88.0, {"BROADCAST_LIMIT": 0}),  # as if the canonical names were too many to broadcast
    (88.0, {"FEW_PAIRS": 0}), (75.0, {"FEW_PAIRS": 0}),  # as if there were many pairs
])
def test_fuzzy_join_equals_brute_force(spark, monkeypatch, threshold, settings):
    for name, value in settings.items():
        monkeypatch.setattr(fuzzy, name, value)
    rng = random.Random(7)
    canon = sorted({"".join(rng.choice("abc d") for _ in range(rng.randint(1, 30))).strip()
                    for _ in range(150)} - {""})
    names = set()
    for base in canon * 3:
        text = list(base)
        for _ in range(rng.randint(0, max(1, len(base) // 5))):
            at = rng.randrange(len(text) + 1)
            if rng.random() < 0.5 and text:
                del text[min(at, len(text) - 1)]
            else:
                text.insert(at, rng.choice("abcd"))
        if "".join(text).strip():
            names.add("".join(text).strip())
    names = sorted(names)

    def key(t):
        return " ".join(sorted(t.lower().split()))

    expected = {}
    for n in names:
        score, best = max(((indel_ratio(key(n), key(c)), c) for c in reversed(canon)),
                          key=lambda p: p[0])
        ties = [c for c in canon if indel_ratio(key(n), key(c)) == score]
        if score >= threshold:
            expected[n] = (ties[0], score)
    got = best_fuzzy_match(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame([(c,) for c in canon], "canonical string"), threshold)
    assert {r["name"]: (r["canonical"], r["score"]) for r in got.collect()} == expected
    assert len(expected) > 100


def test_names_that_all_look_alike(spark):
    """Every name shares most of its pieces with every other: one best match each, all found."""
    canon = [f"Customer#{i:09d}" for i in range(400)]
    names = [c.replace("#", "") for c in canon]
    got = best_fuzzy_match(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame([(c,) for c in canon], "canonical string"), 88.0)
    assert {r["name"]: r["canonical"] for r in got.collect()} == dict(zip(names, canon))


def test_broadcast_fuzzy_join_moves_only_the_names(spark):
    names = spark.createDataFrame([("Teslaa",)], "name string")
    canonicals = spark.createDataFrame([("Tesla",)], "canonical string")
    plan = best_fuzzy_match(names, canonicals, 88.0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # the names, and one best row per name
    assert plan.count("indel_ratio_udf") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_pieces_beyond_the_limit_are_never_broadcast(spark, monkeypatch):
    """A name of a few bytes turns into hundreds of pieces, which Spark's estimate does not see."""
    monkeypatch.setattr(fuzzy, "BROADCAST_LIMIT", 0)
    names = materialise(spark.createDataFrame([(f"Customer{i:09d}",) for i in range(50)], "name string"), "names")
    canonicals = spark.createDataFrame([(f"Customer#{i:09d}",) for i in range(50)], "canonical string")
    pairs = fuzzy._candidates(names, 50, canonicals, 88.0, many=True)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert len(joins) == 1 and "LeftSemi" in joins[0]  # only the lengths that occur


def _hex_names(count):
    """Canonical names without a pattern, and each with a character cut out or overwritten by two."""
    rng = random.Random(11)
    canon = sorted({"".join(rng.choice("0123456789abcdef") for _ in range(20)) for _ in range(count)})
    names = [c[:at] + ("" if i % 2 else "zz") + c[at + 1:]
             for i, c in enumerate(canon) for at in [i % 20]]
    return names, canon


def test_names_without_a_pattern_meet_few_others(spark):
    """20 characters and 3 edits: 4 pieces of 5 characters, each looked for in at most 3 places."""
    names, canon = _hex_names(4000)
    named = materialise(spark.createDataFrame([(n,) for n in names], "name string"), "names")
    canonicals = spark.createDataFrame([(c,) for c in canon], "canonical string")
    right, crowded = fuzzy._canonical_pieces(named, canonicals, 88.0)
    left = fuzzy._name_pieces(named, 88.0, many=True)
    assert crowded is None
    assert right.where("allowed = 3").count() == 4 * 4000
    met = left.join(right, "key").where("name != canonical").select("name", "canonical").distinct()
    assert 4000 <= met.count() < 1.2 * 4000  # 39,742 with pieces of three characters


def test_uncrowded_pieces_are_not_copied(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "BROADCAST_LIMIT", 0)
    names, canon = _hex_names(300)
    pairs = fuzzy._candidates(
        materialise(spark.createDataFrame([(n,) for n in names], "name string"), "names"), 300,
        spark.createDataFrame([(c,) for c in canon], "canonical string"), 88.0, many=True)
    assert "salt" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["name"], r["canonical"]) for r in pairs.collect()} >= set(zip(names, canon))


@pytest.mark.parametrize("crowded,limit", [(0, 0), (2, 0), (2, fuzzy.BROADCAST_LIMIT)])
@pytest.mark.parametrize("threshold", [88.0, 75.0])
def test_crowded_pieces_lose_no_match(spark, monkeypatch, crowded, limit, threshold):
    """Finer cuts, salts and both cuts side by side give what brute force gives."""
    monkeypatch.setattr(fuzzy, "FEW_PAIRS", 0)
    monkeypatch.setattr(fuzzy, "CROWDED", crowded)
    monkeypatch.setattr(fuzzy, "BROADCAST_LIMIT", limit)
    rng = random.Random(5)
    canon = sorted({f"Customer#{rng.randrange(500):05d}" for _ in range(60)}
                   | {"".join(rng.choice("ab") for _ in range(rng.randint(1, 24))) for _ in range(60)}
                   | {"x" * 70 + c * 9 for c in "abc"})
    names = set()
    for base in canon * 4:
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(text) + 1)
            text[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "0", "é", "\U0001f600"])
        if "".join(text).strip():
            names.add("".join(text))
    expected = {}
    for n in names:
        ranked = sorted((-indel_ratio(n.lower(), c.lower()), c) for c in canon)
        if -ranked[0][0] >= threshold:
            expected[n] = (ranked[0][1], -ranked[0][0])
    got = best_fuzzy_match(
        spark.createDataFrame([(n,) for n in sorted(names)], "name string"),
        spark.createDataFrame([(c,) for c in canon], "canonical string"), threshold)
    assert {r["name"]: (r["canonical"], r["score"]) for r in got.collect()} == expected
    assert len(expected) > 100


def test_batch_scorer_equals_the_single_one():
    rng = random.Random(3)
    pairs = [("", ""), ("", "a"), ("a", ""), ("a\0", "a"), ("\0", "\0\0"), ("\U0001f600a", "a\U0001f600")]
    for most in (3, 16, 17, 63, 64, 65, 150):
        for _ in range(60):
            pairs.append(tuple("".join(rng.choice("ab\0é\U0001f600") for _ in range(rng.randint(0, most)))
                               for _ in range(2)))
        pairs.append(("a" * most, "a" * most))
    a, b = (pd.Series(x, dtype=object) for x in zip(*pairs))
    assert list(fuzzy.indel_ratio_udf.func(a, b)) == [indel_ratio(x, y) for x, y in pairs]
    assert len(fuzzy.indel_ratio_udf.func(a[:0], b[:0])) == 0


def test_keys_of_many_canonical_names_are_not_broadcast(spark, monkeypatch):
    """Spark knows the size of the files the names come from, not of the three keys of each."""
    plans = []

    def watched(left, right, on):
        joined = left.join(right, on, "left")
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(resolve, "lookup_join", watched)
    monkeypatch.setattr(resolve, "BROADCAST_NAMES", 2)
    canonicals = spark.createDataFrame([("OpenAI",), ("Tesla",), ("Uber",)], "canonical string")
    names = spark.createDataFrame([("OPENAI",), ("Ubers",), ("nobody",)], "name string")
    got = {r["name"]: r["canonical"] for r in resolve_names(names, canonicals).collect()}
    assert got == {"OPENAI": "OpenAI", "Ubers": "Uber"}
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
