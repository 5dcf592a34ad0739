"""The pipeline on the smallest tables, stage by stage, against plain versions."""

import corpus_pipeline
import pytest

from placetime.llm import pieces, quality, simhash
from tests.llm.test_pieces import plain as plain_cost
from tests.llm.test_pieces import cost_of
from tests.llm.test_pii import plain_base
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def made(spark, sf, tmp_path_factory):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return [[r.asDict() for r in df.collect()] for df in out]


def test_quality(made, spark, sf):
    kept = {r.doc_id for r in quality.judged(spark.read.parquet(f"{sf}/documents.parquet")).collect() if r.kept}
    assert {r["doc_id"] for r in made[1]} == kept
    before = {r["doc_id"]: r for r in made[0]}
    assert all(r == before[r["doc_id"]] for r in made[1])


def test_near_duplicates(made):
    ids, fps = [r["doc_id"] for r in made[1]], [plain_fingerprint(r["text"]) for r in made[1]]
    assert {r["doc_id"] for r in made[2]} == {c for _, c in plain_components(ids, fps)}
    before = {r["doc_id"]: r for r in made[1]}
    assert len(made[2]) < len(made[1]) and all(r == before[r["doc_id"]] for r in made[2])


def test_personal_data(made):
    before = {r["doc_id"]: r["text"] for r in made[2]}
    assert {r["doc_id"] for r in made[3]} == set(before)
    for r in made[3]:
        assert r["n_chars"] == len(r["text"])
        if not plain_base(before[r["doc_id"]]) and "[" not in r["text"]:
            assert r["text"] == before[r["doc_id"]]
        assert plain_base(r["text"]) == []


def test_mixing_and_ids(made):
    texts = {r["doc_id"]: r["text"] for r in made[3]}
    assert all(r["text"] == texts[r["doc_id"]] for r in made[4])
    own = pieces.reader(pieces.load())
    assert sorted(r["doc_id"] for r in made[5]) == sorted(r["doc_id"] for r in made[4])
    for r in made[5][:40]:
        assert own.decode(r["ids"]) == texts[r["doc_id"]] and cost_of(r["ids"]) == plain_cost(texts[r["doc_id"]])
        assert r["n_ids"] == len(r["ids"])


def test_run_gives_the_last_stage(made, spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert sorted((r.doc_id, r.n_ids) for r in got.collect()) == sorted((r["doc_id"], r["n_ids"]) for r in made[5])
    assert simhash.BUDGET == 2
