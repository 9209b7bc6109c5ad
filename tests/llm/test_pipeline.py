"""Each stage against brute force on what the stage before it kept."""

import duckdb
import pytest

import corpus_pipeline
from obslake.llm.nbest_pieces import Pieces, default_model
from obslake.llm.oracles import ORACLES
from obslake.session import materialise
from tests.llm.conftest import FIELDS
from tests.llm.test_line_runs import brute_force as without_runs
from tests.llm.test_order_minhash import classes_by_shingles, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], sf_dir), "stage"))
    return out


def pairs(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_all_but_the_last_stage_return_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "near dedup", "decontamination", "pieces"]
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_language(stages):
    before, after = pairs(stages[0]), pairs(stages[1])
    assert after == {d: t for d, t in before.items() if t and any(c.isalpha() for c in t)}


def test_lines(stages):
    before, after = pairs(stages[1]), pairs(stages[2])
    expected = dict(without_runs(list(before.items())))
    assert after == {d: t for d, t in expected.items() if t.split() or t == before[d]}


def test_near_copies(stages):
    before, after = sorted(pairs(stages[2]).items()), pairs(stages[3])
    found = classes_by_shingles(before, [shingles(t) for _, t in before])
    assert set(after) == set(found.values())


def test_leaks(spark, sf_dir, stages, tmp_path):
    stages[3].toPandas().to_parquet(tmp_path / "documents.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    db.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
    leaked = {r[0] for r in db.execute(ORACLES["op1_template_leaks"]).fetchall()}
    assert set(pairs(stages[4])) == set(pairs(stages[3])) - leaked


def test_pieces_decode_to_the_texts(stages):
    texts, held = pairs(stages[4]), Pieces(default_model())
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    for r in rows:
        assert r["round_trip"] and r["n_ids"] == len(r["ids"]) and held.decode(r["ids"]) == texts[r["doc_id"]]
        assert r["scores"] == sorted(r["scores"], reverse=True)


def test_awkward_texts(spark, awkward, nothing, sf_dir):
    for docs in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, sf_dir), "stage")
            assert docs.columns == awkward.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
        assert all(r["round_trip"] for r in rows)
    assert FIELDS
