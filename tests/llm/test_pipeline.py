import os

import pytest

import corpus_pipeline as C
from conftest import SF_SMALL
from llm_helpers import documents, no_documents, rows  # noqa: F401
from seasonflow.llm import linededup, mixing, packing, quality, simhash
from seasonflow.session import checkpoint_dir
from test_linededup import brute as brute_lines
from test_quality import brute_counts
from test_simhash import brute_fingerprint, brute_groups


@pytest.fixture(scope="module")
def stages(spark, scratch):
    """The result of every stage, each written and read again."""
    docs = [spark.read.parquet(f"{SF_SMALL}/documents.parquet")]
    for i, (_, stage) in enumerate(C.STAGES):
        path = f"{scratch}/pipeline-{i}"
        stage(spark, docs[-1], SF_SMALL).write.parquet(path)
        docs.append(spark.read.parquet(path))
    return docs


def test_stages_and_columns(stages):
    assert [f.__name__ for _, f in C.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mixing_sources", "sequence_packing"]
    for out in stages[1:-1]:
        assert out.columns == stages[0].columns


def test_quality_stage(stages):
    kept = {r["doc_id"] for r in stages[1].collect()}
    for r in stages[0].collect():
        n, _, _, _, repeat = brute_counts(r["text"])
        if n < 10 or 100 * repeat > 20 * n:
            assert r["doc_id"] not in kept


def test_line_stage(stages):
    docs = sorted((r["doc_id"], r["text"]) for r in stages[1].collect())
    want, _ = brute_lines(docs)
    assert {r["doc_id"]: r["text"] for r in stages[2].collect()} == {
        i: t for (i, _), t in zip(docs, want)}


def test_near_duplicate_stage(stages):
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in stages[2].collect()}
    group = brute_groups(fps.values())
    first = {}
    for i, fp in sorted(fps.items()):
        first.setdefault(group[fp], i)
    assert sorted(r["doc_id"] for r in stages[3].collect()) == sorted(first.values())


def test_mixing_stage(stages):
    taken = mixing.mix(stages[3]).where("copies > 0").select("doc.doc_id", "copies").collect()
    counts = {r["doc_id"]: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["copies"] for r in taken}


def test_packing_stage_and_run(spark, stages):
    pieces = stages[5]
    assert pieces.groupBy("sequence_id").sum("length").where(f"`sum(length)` > {packing.SEQ_LEN}").count() == 0
    total = packing.tokenized(stages[4]).agg({"doc_tokens": "sum"}).first()[0]
    assert pieces.agg({"length": "sum"}).first()[0] == total
    folder = checkpoint_dir(spark).removeprefix("file:")
    tables, files = {t.name for t in spark.catalog.listTables()}, set(os.listdir(folder))
    again = C.run(spark, SF_SMALL)
    left = set(os.listdir(folder)) - files
    assert len(left) == 1 and all(left & set(f.split("/")) for f in again.inputFiles())
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert again.columns == pieces.columns and again.agg({"length": "sum"}).first()[0] == total


def test_awkward_rows(spark, documents, rows, no_documents, scratch):
    plain = documents.select("doc_id", "text", "lang", "source", "n_chars")
    out = plain
    for i, (_, stage) in enumerate(C.STAGES[:-1]):
        stage(spark, out, SF_SMALL).write.parquet(f"{scratch}/awkward-{i}")
        out = spark.read.parquet(f"{scratch}/awkward-{i}")
    assert out.columns == plain.columns and out.count() > 0
    for _, stage in C.STAGES:
        assert stage(spark, no_documents, SF_SMALL).count() == 0


def test_modules_used():
    assert {quality, linededup, simhash, mixing, packing} <= {
        v for v in vars(C).values() if getattr(v, "__name__", "").startswith("seasonflow.llm.")}
