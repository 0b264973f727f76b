import numpy as np

from conftest import SF_ORACLE
from llm_helpers import documents, no_documents, rows, words  # noqa: F401
from seasonflow.llm import mixing as M
from seasonflow.llm.catalogue import QUERIES


def brute_targets(sizes):
    """Share out, cut at the cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float(M.WEIGHTS[i % 3]) for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


def check(got, docs, tolerance):
    sizes = {}
    for d in docs:
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(words(d["text"]))
    target = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    largest = {s: max(len(words(d["text"])) for d in docs if d["source"] == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - target[s]) <= min(largest[s], max(100, tolerance * target[s])), s


def test_query(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()
    source = {d["doc_id"]: d["source"] for d in docs}
    size = {d["doc_id"]: len(words(d["text"])) for d in docs}
    first = QUERIES["op5_mixing"](spark, SF_ORACLE).collect()
    assert all(r["size"] == size[r["doc_id"]] for r in first) and len(first) == len(docs)
    check([r.asDict() | {"source": source[r["doc_id"]]} for r in first], docs, 0.05)
    again = QUERIES["op5_mixing"](spark, SF_ORACLE).collect()
    assert sorted(first) == sorted(again)


def test_flight_keeps_both_totals_and_every_probability():
    rng = np.random.default_rng(5)
    size = rng.integers(1, 5000, 500)
    total = np.zeros(500)
    for k in range(200):
        prob = M.flight(np.full(500, 0.3), size, rng.random(600))
        still = (prob > 0) & (prob < 1)
        assert still.sum() <= 2
        assert abs(prob.sum() - 150) < 1e-6 and abs(prob @ size - 0.3 * size.sum()) < 1e-3
        total += prob
    assert abs(total.mean() / 200 - 0.3) < 1e-6 and total.max() < 200 * 0.5


def test_flight_with_equal_sizes_decides_all_but_one():
    prob = M.flight(np.full(101, 0.5), np.full(101, 7), np.random.default_rng(1).random(200))
    assert ((prob > 0) & (prob < 1)).sum() <= 1 and abs(prob.sum() - 50.5) < 1e-9


def test_many_blocks(spark):
    """Several levels of blocks leave the totals where one block would."""
    units = spark.range(20_000).selectExpr(
        "id as rid", "'s' as source", "1 + pmod(xxhash64(id), 900) as size",
        "xxhash64(id, 1) as mark", "0.37D as prob")
    taken = M.balanced_sample(units, block=50)
    got = units.join(taken, "rid").selectExpr(
        "count(*)", "sum(taken)", "sum(taken * size)", "0.37 * sum(size)").first()
    assert got[0] == 20_000 and abs(got[1] - 7400) <= 2 and abs(got[2] - float(got[3])) <= 900


def test_awkward_rows(documents, rows, no_documents):
    got = M.mix(documents).select("doc.doc_id", "source", "size", "source_size", "target", "copies")
    got = [r.asDict() | {"taken": r["size"] * r["copies"]} for r in got.collect()]
    assert len(got) == len(rows)
    check(got, [{"source": r[3], "text": r[1]} for r in rows], 0.2)
    mixed = M.mixed_rows(documents)
    assert mixed.columns == documents.columns
    assert mixed.count() == sum(r["copies"] for r in got)
    assert M.mix(no_documents).count() == 0
